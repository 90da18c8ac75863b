"""Benchmark decontamination by templates.

A text becomes tokens: lower-cased words, and numbers, units after numbers, and names, which are typed
slots. Windows of eight tokens of every document are hash-joined with those of the benchmark in four
forms: plain (every value kept), number slots only, names by their context, and every capitalised word
a slot. So a question stays recognisable when its numbers or names are changed, and neither letter case nor
the text around it decides. A window counts if its tokens are equal or slots of one kind; if any value
changed, five equal words apart from slots are asked for, and in one occurrence a changed value of the
item must stand for one value of the document (two values of the item may meet in one of the document's,
as changed numbers can coincide). Windows that break this do not count, others do.

DataFrame functions throughout, each text marked once for all widths, in time linear in its tokens.
Windows of documents are probed as they are made; only matches leave a task. The benchmark's windows are broadcast behind a count, above which the same join shuffles.

Names need letter case and tokens need spaces: texts in scripts without them have no name slots and are
matched by their plain tokens. Null texts are empty and empty items are held by nothing. Items shorter than a window are one window; a
short one is held by every text with its tokens in a row. Documents that share an id are judged by their texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ledgercast.session import stage_path
from ledgercast.sources.stages import staged

WINDOW = 8
LEXICAL = 5
SHARE = 0.5
LONG_RUN = 40
BROADCAST_WINDOWS = 200_000
BROADCAST_TEXTS = 500_000

# Units that make a slot when they follow a number.
UNITS = (
    "km|cm|mm|nm|m|kg|mg|g|lb|oz|ml|l|ms|s|min|h|hz|kw|w|v|a|j|mph|kmh|mb|gb|tb|kb|%|€|\\$|£|"
    "meters?|metres?|miles?|feet|inches|grams?|liters?|litres?|seconds?|minutes?|hours?|days?|weeks?|months?|years?|"
    "dollars?|euros?|cents?|percent|degrees?"
)
NUMBER_SLOT, NAME_SLOT, UNIT_SLOT, POINT, CAPITAL = "\u0001", "\u0002", "\u0003", "\u0004", "\u0005"
PAIR = "\u0006"
SLOTS = f"[{NUMBER_SLOT}-{UNIT_SLOT}]"
MARKS = f"[{NUMBER_SLOT}-{UNIT_SLOT}{CAPITAL}]"
NUMBERS = r"\p{N}"
NUMBER = r"\p{N}+(?:[.,:]\p{N}+)*"
# Everything between words: ASCII but letters, digits and the marks; the punctuation of other blocks.
# Characters below 256 are listed one by one, as Java looks those up in a table and tries ranges in turn.
BETWEEN = "".join(
    rf"\x{code:02X}"
    for first, last in (
        (0, 0), (6, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0xA9), (0xAB, 0xB1), (0xB4, 0xB4), (0xB6, 0xB8), (0xBB, 0xBB),
        (0xBF, 0xBF), (0xD7, 0xD7), (0xF7, 0xF7),
    )
    for code in range(first, last + 1)
) + r"\x{2000}-\x{206F}\x{20A0}-\x{20CF}\x{3000}-\x{303F}"


def marked_text(text: Column) -> Column:
    """Lower-cased tokens split by one space, each slot its mark and its value.

    Capitalised words that their context does not make names, as at the start of a sentence, have a mark
    of their own. Marks aside, the tokens depend on nothing but the words. Patterns look ahead before they
    look behind: most places fail by their own character, which is far cheaper.
    """
    marks = f"[{NUMBER_SLOT}-{CAPITAL}]"
    text = F.coalesce(text, F.lit(""))
    text = F.when(text.rlike(marks), F.regexp_replace(text, marks, " ")).otherwise(text)
    units = F.regexp_replace(text, rf"({NUMBER})\s?(?i:({UNITS}))(?![\p{{L}}\p{{N}}])", f" {NUMBER_SLOT}$1 {UNIT_SLOT}$2 ")
    numbers = F.regexp_replace(units, rf"(?=\p{{N}})(?<![\p{{N}}{NUMBER_SLOT}])(?<!\p{{N}}[.,:])({NUMBER})", f" {NUMBER_SLOT}$1 ")
    joined = F.regexp_replace(numbers, r"(?=[.,:])(?<=\p{N})[.,:](?=\p{N})", POINT)
    slotted = F.when(text.rlike(NUMBERS), joined).otherwise(text)
    named = F.regexp_replace(slotted, r" (?<=[\p{Ll},;:] )(?=\p{Lu}\p{Ll})", f" {NAME_SLOT}")
    named = F.regexp_replace(named, rf"(?=\p{{Lu}}\p{{Ll}})(?<![^{BETWEEN}])", CAPITAL)
    return F.lower(F.trim(F.regexp_replace(named, f"[{BETWEEN}]+", " ")))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _window_at(tokens: Column, position: Column, width: Column | int) -> Column:
    """Tokens of one window, by index: a slice inside a lambda would copy the whole text."""
    last = width - 1 if isinstance(width, Column) else F.lit(width - 1)
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.get(tokens, position + k))


FORMS = ["plain", "numbers", "names", "capitals"]


def token_hashes(tokens: Column, marked: Column) -> list[Column]:
    """Hashes of the tokens in the four forms: plain, numbers, names, capitals.

    A slot is reduced to its mark, and marks lead their token. A form equal to another is null.
    """
    number, name, unit = (F.xxhash64(F.lit(mark)) for mark in (NUMBER_SLOT, NAME_SLOT, UNIT_SLOT))

    def plain(t: Column) -> Column:
        return F.xxhash64(F.when(t < F.lit(PAIR), F.substring(t, 2, 1 << 30)).otherwise(t))

    def numbers(t: Column) -> Column:
        return F.when(t < NAME_SLOT, number).when((t >= UNIT_SLOT) & (t < POINT), unit)

    def names(t: Column) -> Column:
        return F.when(t < NAME_SLOT, number).when(t < UNIT_SLOT, name).when(t < POINT, unit)

    def reduced(slots: Callable[[Column], Column]) -> Column:
        return F.transform(tokens, lambda t: F.when(t >= F.lit(PAIR), F.xxhash64(t)).otherwise(F.coalesce(slots(t), plain(t))))

    return [
        F.transform(tokens, plain),
        F.when(marked.rlike(f"[{NUMBER_SLOT}{UNIT_SLOT}]"), reduced(numbers)),
        F.when(marked.rlike(NAME_SLOT), reduced(names)),
        F.when(marked.rlike(CAPITAL), reduced(lambda t: names(t).when(t < F.lit(PAIR), name))),
    ]


def _joined(hashes: Column, step: int) -> Column:
    """Hash of each element with the one ``step`` places on."""
    later = F.slice(hashes, F.lit(step + 1), F.greatest(F.size(hashes) - step, F.lit(0)))
    return F.zip_with(hashes, later, lambda a, b: F.xxhash64(a, b))


def window_hashes(hashes: Column, width: int) -> Column:
    """Hash of the window at every position, by doubling: two stretches that overlap or meet make one window."""

    def widened(known: Column, reach: int) -> Column:
        if reach == width:
            return F.slice(known, F.lit(1), F.greatest(F.size(known) - (width - 1), F.lit(0)))
        step = min(reach, width - reach)
        return bound(_joined(known, step), lambda wider: widened(wider, reach + step))

    return bound(hashes, lambda known: widened(known, 1))


def explode_forms(df: DataFrame, widths: list[int], *keep: str) -> DataFrame:
    """``position, width, hash`` of the windows in every form beside the kept columns: equal hashes of a
    position once."""

    def at_width(forms: list[Column], width: int) -> Column:
        return F.struct(*[window_hashes(form, width).alias(name) for name, form in zip(FORMS, forms)])

    def of(marked: Column) -> Column:
        return bound(F.split(marked, " "), lambda tokens: F.array(*[at_width(token_hashes(tokens, marked), w) for w in widths]))

    # One list per form, read by position: a list of structs would be built and copied at many times the cost.
    lists = df.select(*keep, F.posexplode(bound(F.col("marked"), of)).alias("which", "windows")).select(*keep, "which", "windows.*")
    placed = lists.select(*keep, "which", *FORMS, F.posexplode("plain").alias("position", "first"))
    at = [F.col("first"), *[F.get(name, F.col("position")) for name in FORMS[1:]]]
    placed = placed.select(*keep, "which", "position", *[hash_at.alias(name) for name, hash_at in zip(FORMS, at)])
    fresh = [F.col("plain")]
    for k, name in enumerate(FORMS[1:], 1):
        known = F.lit(False)
        for earlier in FORMS[:k]:
            known = known | F.col(name).eqNullSafe(F.col(earlier))
        fresh.append(F.when(~known, F.col(name)))
    width = F.element_at(F.array(*[F.lit(w) for w in widths]), F.col("which") + 1).alias("width")
    return placed.select(*keep, "position", width, F.explode(F.array(*fresh)).alias("hash")).where("hash IS NOT NULL")


def _marked(df: DataFrame, *keep: Column) -> DataFrame:
    return df.select(*keep, marked_text(F.col("text")).alias("marked"))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``hash, item_id, item_position, item_window, item_tokens, width``, a row per form of a window.

    Items shorter than a window are one window of their own width.
    """
    items = _marked(benchmark, F.col("item_id")).distinct().where("marked <> ''")
    items = items.withColumn("tokens", F.split("marked", " ")).withColumn("item_tokens", F.size("tokens"))
    own_width = F.least(F.col("item_tokens"), F.lit(WINDOW))
    widths = [r["width"] for r in items.select(own_width.alias("width")).distinct().collect()]  # at most 8 rows
    windows = []
    for width in sorted(widths) or [WINDOW]:
        windows.append(
            explode_forms(items.where(own_width == width), [width], "item_id", "tokens", "item_tokens").select(
                "hash", "item_id", F.col("position").alias("item_position"),
                _window_at(F.col("tokens"), F.col("position"), width).alias("item_window"), "item_tokens", "width",
            )
        )
    every = windows[0]
    for more in windows[1:]:
        every = every.union(more)
    return every


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def bounded(rows: DataFrame, most: int) -> DataFrame:
    """A written table, marked for broadcast if it is small enough; otherwise joins shuffle it."""
    return F.broadcast(rows) if rows.count() <= most else rows


def hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``text_key, position, width, hash`` of the windows of distinct texts that the benchmark has."""
    spark = docs.sparkSession
    widths = [r["width"] for r in windows.select("width").distinct().collect()]  # at most 8 rows
    known = bounded(staged(windows.select("hash", "width").distinct(), stage_path(spark, "hashes")), BROADCAST_WINDOWS)
    # Empty texts have no window that an item has; asking for them here would mark every text twice.
    marked = _marked(docs, text_key(F.col("text")).alias("text_key"))
    exploded = explode_forms(marked, sorted(widths) or [WINDOW], "text_key")
    # Joined by the hash alone, one long, which Spark looks up without building a row for it.
    same = exploded.join(known.withColumnRenamed("width", "known_width"), "hash").where("width = known_width").drop("known_width")
    return staged(same.distinct(), stage_path(spark, "hits"))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Windows of distinct texts that equal a benchmark window, with the values in their slots.

    A slot pair is one string, the item's value and the document's.
    """
    spark = docs.sparkSession
    windows = staged(benchmark_windows(benchmark), stage_path(spark, "windows"))
    found = hits(docs, windows)
    keys = staged(found.select("text_key").distinct(), stage_path(spark, "keys"))
    texts = docs.select(text_key(F.col("text")).alias("text_key"), "text").join(bounded(keys, BROADCAST_TEXTS), "text_key", "left_semi")
    texts = _marked(texts.groupBy("text_key").agg(F.first("text").alias("text")), F.col("text_key"))
    places = found.groupBy("text_key").agg(F.collect_list(F.struct("position", "width", "hash")).alias("places"))
    read = bound(
        F.split("marked", " "),
        lambda tokens: F.transform(
            F.col("places"),
            lambda w: F.struct(w["position"], w["width"], w["hash"], _window_at(tokens, w["position"], w["width"]).alias("window")),
        ),
    )
    placed = texts.join(places, "text_key").select("text_key", F.explode(read).alias("w"))
    placed = placed.select("text_key", *[F.col(f"w.{c}").alias(c) for c in ("position", "width", "hash", "window")])
    pairs = F.transform(
        F.arrays_zip(F.col("item_window").alias("item"), F.col("window").alias("doc")),
        lambda p: F.struct(
            kind(p["item"]).alias("kind"), kind(p["doc"]).alias("doc_kind"), F.regexp_replace(p["item"], MARKS, "").alias("item"),
            F.regexp_replace(p["doc"], MARKS, "").alias("doc"), p["item"].rlike(SLOTS).alias("slot"),
        ),
    )
    compared = placed.join(windows, ["hash", "width"]).withColumn("pairs", pairs)
    same = F.forall("pairs", lambda p: (p["item"] == p["doc"]) | ((p["kind"] != "") & (p["kind"] == p["doc_kind"])))
    unchanged = F.forall("pairs", lambda p: p["item"] == p["doc"])
    words = F.size(F.filter("pairs", lambda p: (p["item"] == p["doc"]) & ~p["slot"]))
    slots = F.transform(F.filter("pairs", lambda p: p["kind"] != ""), lambda p: F.concat(p["item"], F.lit(PAIR), p["doc"]))
    return compared.where(same & (unchanged | (words >= LEXICAL))).select(
        "text_key", "item_id", "item_tokens", "item_position", "width",
        (F.col("position") - F.col("item_position")).alias("shift"), F.array_distinct(slots).alias("slots"),
    )


def kind(token: Column) -> Column:
    """Mark of a slot; capitalised words count as names, other words have none."""
    return F.translate(F.regexp_extract(token, MARKS, 0), CAPITAL, NAME_SLOT)


def covered_tokens(positions: Column, width: Column) -> Column:
    """Tokens covered by windows of one width at the given positions."""

    def gaps(ordered: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(ordered)),
            lambda i: F.when(i == F.size(ordered), width).otherwise(F.least(width, F.element_at(ordered, i + 1) - F.element_at(ordered, i))),
        )

    return F.aggregate(bound(F.array_sort(positions), gaps), F.lit(0), lambda total, gap: total + gap)


def item_value(pair: Column) -> Column:
    return F.substring_index(pair, PAIR, 1)


def is_changed(pair: Column) -> Column:
    return item_value(pair) != F.substring_index(pair, PAIR, -1)


def conflicting(pairs: Column) -> Column:
    """Pairs of a changed value whose item value stands for another value of the document too.

    Sorted, the pairs of one item value are neighbours.
    """

    def met(ordered: Column) -> Column:
        def twice(pair: Column, at: Column) -> Column:
            before = F.when(at > 0, item_value(F.get(ordered, at - 1)))
            shared = before.eqNullSafe(item_value(pair)) | item_value(F.get(ordered, at + 1)).eqNullSafe(item_value(pair))
            return is_changed(pair) & shared

        return F.filter(ordered, twice)

    return bound(F.array_sort(F.array_distinct(pairs)), met)


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``text_key, item_id, covered, item_tokens, share, changed_slots`` of each distinct text that
    holds a benchmark item: half of its tokens or 40 of them, in windows with consistent slots."""
    key = ["text_key", "item_id", "item_tokens", "width"]
    window = F.struct("item_position", "slots")
    occurrences = matches(docs, benchmark).groupBy(*key, "shift").agg(
        F.collect_set(window).alias("windows"), conflicting(F.flatten(F.collect_set("slots"))).alias("conflicts")
    )
    kept = occurrences.withColumn(
        "windows", F.filter("windows", lambda w: ~F.arrays_overlap(w["slots"], "conflicts"))
    ).where(F.size("windows") > 0)
    slots = F.array_distinct(F.flatten(F.col("windows.slots")))
    changed = F.size(F.filter(slots, is_changed))
    merged = kept.groupBy(*key).agg(
        F.array_distinct(F.flatten(F.collect_set("windows.item_position"))).alias("positions"), F.min(changed).alias("changed_slots")
    )
    measured = merged.withColumn("covered", covered_tokens(F.col("positions"), F.col("width")))
    share = F.col("covered") / F.col("item_tokens")
    held = measured.where((share >= SHARE) | (F.col("covered") >= LONG_RUN)).select(
        "text_key", "item_id", "covered", "item_tokens", share.alias("share"), "changed_slots"
    )
    return staged(held, stage_path(docs.sparkSession, "held"))


def contaminated_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document id and benchmark item; the best of several texts under one id."""
    held = bounded(contaminations(docs, benchmark), BROADCAST_TEXTS)
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key")).join(held, "text_key")
    best = F.struct("covered", (-F.col("changed_slots")).alias("order"), "text_key", "item_tokens", "share", "changed_slots")
    return keyed.groupBy("doc_id", "item_id").agg(F.max(best).alias("best")).select(
        "doc_id", "item_id", *[F.col(f"best.{c}").cast("long").alias(c) for c in ("covered", "item_tokens")], "best.share",
        F.col("best.changed_slots").cast("long").alias("changed_slots"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose text holds no benchmark item, in their own columns."""
    leaked = contaminations(docs, benchmark).select(F.col("text_key").alias("leaked_key"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, text_key(F.col("text")).alias("text_key"))
    return keyed.join(bounded(leaked, BROADCAST_TEXTS), F.col("text_key") == F.col("leaked_key"), "left_anti").select("row.*")
