"""The templates against a plain-Python twin: windows, forms, consistency, cover, share and changed slots."""

import random
import time
from collections import defaultdict

import pytest
import regex

from ledgercast.llm import decontaminate as d

SCHEMA = "doc_id long, text string, source string, text_key string, hash long"


def marked_tokens(text):
    """(mark, value) of every token; Java's flags are ASCII where these are."""
    text = regex.sub("[\x01-\x05]", " ", text or "")
    if regex.search(r"\p{N}", text):
        units = d.UNITS.replace("\\$", "[$]")
        text = regex.sub(rf"({d.NUMBER})[ \t\n\x0b\f\r]?((?i:{units}))(?![\p{{L}}\p{{N}}])", "  \x01\\1 \x03\\2 ", text)
        text = regex.sub(rf"(?<![\p{{N}}\x01])(?<!\p{{N}}[.,:])({d.NUMBER})", " \x01\\1 ", text)
        text = regex.sub(r"(?<=\p{N})[.,:](?=\p{N})", "\x04", text)
    text = regex.sub(r"(?<=[\p{Ll},;:] )(?=\p{Lu}\p{Ll})", "\x02", text)
    between = regex.sub(r"\\x\{(....)\}", r"\\u\1", d.BETWEEN)
    text = regex.sub(rf"(?<![^{between}])(?=\p{{Lu}}\p{{Ll}})", "\x05", text)
    text = regex.sub(f"[{between}]+", " ", text)
    tokens = text.strip(" ").lower().split(" ")
    return [(t[0], t[1:]) if t[0] in "\x01\x02\x03\x05" else ("", t) for t in tokens if t]


def form(token, name):
    mark, value = token
    slots = {"plain": "", "numbers": "\x01\x03", "names": "\x01\x02\x03", "capitals": "\x01\x02\x03\x05"}[name]
    if mark and mark in slots:
        return "\x02" if mark == "\x05" else mark
    return value


def twin(docs, items):
    """{(text, item): (covered, tokens, changed)} by trying every pair of windows in every form."""
    found = {}
    for text in {t or "" for _, t in docs}:
        have = marked_tokens(text)
        for item_id, item in items:
            want = marked_tokens(item)
            if not want:
                continue
            width = min(len(want), d.WINDOW)
            shifts = defaultdict(dict)
            for i in range(len(have) - width + 1):
                for j in range(len(want) - width + 1):
                    a, b = want[j : j + width], have[i : i + width]
                    if not any(all(form(x, f) == form(y, f) for x, y in zip(a, b)) for f in d.FORMS):
                        continue
                    equal_kind = lambda x: "\x02" if x == "\x05" else x
                    ok = all(x[1] == y[1] or (x[0] and equal_kind(x[0]) == equal_kind(y[0])) for x, y in zip(a, b))
                    lexical = sum(x[1] == y[1] and x[0] not in ("\x01", "\x02", "\x03") for x, y in zip(a, b))
                    if ok and (all(x[1] == y[1] for x, y in zip(a, b)) or lexical >= d.LEXICAL):
                        shifts[i - j][j] = {(x[1], y[1]) for x, y in zip(a, b) if x[0]}
            positions, changed = set(), []
            for windows in shifts.values():
                pairs = set().union(*windows.values())
                bad = {p for p in pairs if p[0] != p[1] and any(q[0] == p[0] and q[1] != p[1] for q in pairs)}
                good = {j: s for j, s in windows.items() if not s & bad}
                if good:
                    positions |= set(good)
                    changed.append(sum(x != y for x, y in set().union(*good.values())))
            covered = len({p + k for p in positions for k in range(width)})
            if covered and (covered / len(want) >= d.SHARE or covered >= d.LONG_RUN):
                found[text, item_id] = (covered, len(want), min(changed))
    return found


def phrase(rng, words):
    vocabulary = "river stone walks to the over old sand with from market hours km".split() * 3
    vocabulary += ["Alice", "Bob", "7", "41", "3,5", "Ünder", "²", "x²", "Maria"]
    return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", " ", ". ", ", ", "\n", ": ", "-"]) for _ in range(words))


def test_random_texts_match_the_twin(spark):
    rng = random.Random(17)
    items = [(k, phrase(rng, rng.choice([1, 3, 7, 8, 12, 30, 90]))) for k in range(14)] + [(90, None), (91, ""), (92, " .")]
    items.append(items[5])  # a repeated row
    docs = [(1, None), (1, ""), (None, phrase(rng, 20)), (2, "the"), (3, "the " * 400)]
    for k in range(60):
        item = rng.choice(items)[1] or ""
        swap = {"7": "9", "41": "12", "3,5": "8", "Alice": "Carol", "Bob": "Maria"}
        changed = "".join(swap.get(w, w) if rng.random() > 0.1 else rng.choice([w, w, "sand", "9"]) for w in regex.split(r"(\W)", item))
        docs.append((k, phrase(rng, rng.randint(0, 30)) + rng.choice([item, changed, item.upper(), item.title()]) + phrase(rng, 5)))
    docs += docs[-5:]
    table = spark.createDataFrame([(i, t, "s", "clash", 0) for i, t in docs], SCHEMA)
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, text_key string")
    want = twin(docs, dict(items).items())
    key = {r["k"]: r["text"] or "" for r in table.select("text", d.text_key(table["text"]).alias("k")).collect()}
    got = {
        (key[r["text_key"]], r["item_id"]): (r["covered"], r["item_tokens"], r["changed_slots"])
        for r in d.contaminations(table, bench).collect()
    }
    assert got == want
    assert len(want) > 40 and sum(c > 0 for _, _, c in want.values()) >= 5
    kept = d.drop_contaminated(table, bench)
    assert kept.columns == table.columns
    bad = {t for t, _ in want}
    assert sorted(r["text"] or "" for r in kept.collect()) == sorted(t or "" for _, t in docs if (t or "") not in bad)


def test_values_may_meet_in_one_but_not_part(spark):
    two, one = (f"mix 3 cups of flour and then add {k} cups of milk to it" for k in (5, 3))
    bench = spark.createDataFrame([(1, two), (2, one)], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "mix 4 cups of flour and then add 4 cups of milk to it"), (2, "mix 6 cups of flour and then add 7 cups of milk to it")],
        "doc_id long, text string",
    )
    got = {(r["doc_id"], r["item_id"]) for r in d.contaminated_items(docs, bench).collect()}
    assert got == {(1, 1), (1, 2), (2, 1)}


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "some text")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert d.contaminated_items(docs, bench).collect() == [] and d.drop_contaminated(docs, bench).count() == 1
    assert d.drop_contaminated(docs.limit(0), spark.createDataFrame([(1, "some text")], "item_id long, text string")).collect() == []


@pytest.mark.parametrize("repeated", [False, True])
def test_time_is_linear_in_the_tokens_of_a_text(spark, repeated):
    rng = random.Random(3)
    words = ["same"] if repeated else [a + b + c for a in "bdfgk" for b in "aeiou" for c in "lmnrst"] + ["Alice", "17"]
    seconds = {}
    for tokens in (10_000, 100_000):
        text = " ".join(rng.choice(words) for _ in range(tokens))
        docs = d._marked(spark.createDataFrame([(1, text)], "doc_id long, text string"), d.F.col("doc_id"))
        rows = d.explode_forms(docs, [d.WINDOW], "doc_id")
        runs = []
        for _ in range(3):
            start = time.time()
            assert rows.agg(d.F.count_distinct("position")).first()[0] == tokens - d.WINDOW + 1
            runs.append(time.time() - start)
        seconds[tokens] = min(runs)
    assert seconds[100_000] < 30 * max(seconds[10_000], 0.2)


def test_probing_marks_a_text_once(spark, monkeypatch):
    plans, staged = {}, d.staged

    def kept(df, path, *more):
        plans[path.rsplit("/", 1)[-1].split("-")[0]] = df._jdf.queryExecution().optimizedPlan().toString()
        return staged(df, path, *more)

    monkeypatch.setattr(d, "staged", kept)
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "so One two three four five six seven eight nine"), (2, ""), (3, None)], "doc_id long, text string")
    assert [r["doc_id"] for r in d.contaminated_items(docs, bench).collect()] == [1]
    assert plans["hits"].count("lower(trim(") == 1
