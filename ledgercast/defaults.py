"""Product and item groups of the published bank ledger."""

from __future__ import annotations

from ledgercast.dimensions import Dimensions

# Product groups and their codes.
PRODUCT_CODES = {
    "AccCurr": (3020200,),
    "Dep": (3020100,),
    "Oms": (3020300,),
    "PersCredit": (3010100, 3010101, 3010102, 3010103),
    "Mortgage": (3010300, 11040186, 11040187, 11040188, 11040189),
    "CreditCard": (3050200, 3050210, 3050220, 3050302),
    "DebitCard": (3050100, 3050110, 3050120, 3050130, 3050140, 3050150, 3050301),
}

# P&L item groups and their codes.
ITEM_CODES = {
    "NetIntInc": (
        19, 20, 21, 26, 27, 28, 29, 30, 31, 1038, 1039, 1040, 1041, 1042, 1045, 1052, 1064, 1069,
        1090, 1091, 1092, 1100, 1101, 1102, 1103, 1575, 1825, 1834, 1835, 1937, 2369, 2960,
    ),
    "CommInc": (
        35, 36, 37, 38, 39, 40, 41, 42, 43, 44, 47, 49, 50, 51, 52, 53, 54, 198, 217, 226, 227, 228,
        1032, 1035, 1111, 1122, 1124, 1536, 1537, 1538, 1770, 1771, 2335, 2336, 2337, 2338, 2340,
        2341, 2342, 2343, 2344, 2345, 2346, 2347, 2661, 2662, 2742, 3114, 3467,
    ),
    "CommCost": (58, 59, 61, 194, 196, 1643, 1684, 1876, 1942, 1943, 2763, 2975, 2976),
    "Fines": (67, 1128, 1137, 1141),
    "ReserveCost": (193, 1144, 1327, 1328, 1777, 1778, 1779, 1780, 1781, 1782, 1857, 1858),
    "OperCost": (300,),
    "OthOperInc": (
        1614, 2068, 2117, 2315, 2350, 2352, 2353, 2354, 2355, 2633, 2778, 2957, 3115, 3121, 3125,
        3126, 3127, 3128, 3129, 3130, 3131, 3358, 3436,
    ),
    "InsOper": (1865, 1866),
}


def bank_dimensions() -> Dimensions:
    return Dimensions(PRODUCT_CODES, ITEM_CODES)
