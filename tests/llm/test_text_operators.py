"""Base spans, counts and removals against plain models of their contracts."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from litsieve.llm import decontam, license_scan, mixing, pii, quality, queries, secret_scan, simhash, substring_dedup
from litsieve.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "text", "source")


def mixed_texts(seed, pieces, count=150):
    draw = random.Random(seed)
    return [(i, "".join(draw.choice(pieces) for _ in range(draw.randrange(1, 40)))) for i in range(count)]


def spans(text, patterns):
    rows = []
    for k, (kind, pattern, fits) in enumerate(patterns):
        rows += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if fits(m)]
    return [r[2] for r in sorted(rows)]


def luhn(m):
    d = [int(c) for c in m.group() if c.isdigit()][::-1]
    return 12 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) < 256 for p in m.group().split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", luhn),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= sum(c.isdigit() for c in m.group()) <= 15),
]
SECRETS = [
    ("assign", r"(?a:(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+))",
     lambda m: len(m[1]) >= 12),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 18),
    ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 16),
]


@pytest.mark.parametrize(
    "scan,patterns,pieces",
    [
        (pii.scanned, PII, ["a", "b.c", "@", "x@y.z", "x@y.zu%v@w.x", ".", "1.2.3.4", "256.1.1.1", "1.2.3", "4111 1111 1111 1111",
                            "4111-1111-1111-1111", "7", "+1 (017) 555-7713", "+", " ", "-", "é😀", "00000000001", "(", "\n"]),
        (secret_scan.scanned, SECRETS, ["token", "PassWord", "api_key", "APIKEY", " ", "=", ":", "'", '"', "abcdefgh", "deadbeef",
                                        "0123456789", "AKIA", "ABCDEFGH", "XYZ9876", "é😀", ".", "\n", "secret = ", "K"]),
    ],
)
def test_base_spans(spark, folder, scan, patterns, pieces):
    rows = mixed_texts(3, pieces) + [(r.doc_id + 1000, r.text) for r in texts(spark, folder).collect()]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        base = spans(t, patterns)
        assert got[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), (t, base, got[i])
        kinds = Counter(s.split(":")[0] for s in base)
        assert all(got[i][f"n_{k}"] == kinds[k] for k, *_ in patterns)
        assert set(base) <= set(got[i].spans.split(",")) | {""}


def test_disguised_identifiers_map_back():
    for text, span in [
        ("write to jane.doe (at) example (dot) com now", (9, 40)), ("mail jоhn@exаmple.com", (5, 21)),
        ("john at example dot com", (0, 23)), ("４１１１ 1111 1111 1111", (0, 19)),
        ("card four one one one 1 1 1 1 one one one one 1 1 1 1", (5, 53)), ("jane@exam​ple.com", (0, 17)),
    ]:
        base, every = pii.find(text)
        assert [s[:2] for s in every if s not in base] == [span], (text, every)
    for text in ("meet at noon dot", "we were at home (at last)", "one two three"):
        assert pii.find(text) == ([], [])
    assert pii.masked("to a@b.c or +1 (017) 555-7713.") == "to [EMAIL] or [PHONE]."


def test_partly_disguised_identifiers_are_found_whole():
    for text, base, whole, left in [
        ("mail jоhn@example.com", (7, 21), (5, 21), "mail [EMAIL]"),
        ("john (dot) smith@example.com!", (11, 28), (0, 28), "[EMAIL]!"),
        ("to jane@mail.example (dot) com", (3, 20), (3, 30), "to [EMAIL]"),
    ]:
        first, every = pii.find(text)
        assert first == [(*base, "email")] and sorted(every) == sorted([(*base, "email"), (*whole, "email")]), text
        assert pii.masked(text) == left
    text = "а a@b.c"  # disguised elsewhere: no second span
    assert pii.find(text) == ([(2, 7, "email")],) * 2


def test_random_strings_are_secrets_and_names_are_not(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    ratio = secret_scan.ratios(secret_scan.samples(docs))

    def mean(s):
        return sum(ratio[ord(a) * 128 + ord(b)] for a, b in zip(s, s[1:])) / (len(s) - 1)

    draw = random.Random(2)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    made = ["".join(draw.choice(alphabet) for _ in range(32)) for _ in range(300)]
    assert np.mean([mean(s) >= secret_scan.CUT for s in made]) > 0.98
    words = {w for r in docs.collect() for w in re.findall("[A-Za-z]{12,}", r.text or "")}
    assert np.mean([mean(w) >= secret_scan.CUT for w in words]) < 0.005


def test_short_random_strings_are_secrets_and_numbers_are_not(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    keys = ["q7ZkP2xVb9Tw", "Xr4Kw9QzT7mBv2Lp", "aG5tR8wQz3XkV6nJpY2"]
    rows = [(-1 - i, f"the key {k} here") for i, k in enumerate([*keys, "9385720416283", "7305918264027351", "internationally"])]
    both = docs.union(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r.spans for r in secret_scan.scanned(both).filter("doc_id < 0").collect()}
    assert got == {-1 - i: f"random:8:{8 + len(k)}" for i, k in enumerate(keys)} | {-4: "", -5: "hex:8:24", -6: ""}


def test_ordinary_words_are_of_all_documents(spark):
    docs = spark.range(6000).selectExpr("id doc_id", "'ordinary' text")
    assert secret_scan.samples(docs).filter("not random").count() == 6000


def test_quality_counts(spark, folder):
    rows = mixed_texts(5, ["a ", "b ", "c\n", "#x ", "a b c\n", "\n", " ", "é ", "\x1f", "\t", "😀 | "]) + [
        (r.doc_id + 1000, r.text) for r in texts(spark, folder).collect()
    ]
    for _, t in rows:
        words = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        again = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
        expected = [len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"),
                    len(lines) - len(set(lines)), len(again)]
        assert quality.statistics(t)[0] == expected


def test_trees_obey_signs_and_learn():
    draw = np.random.default_rng(4)
    x = draw.random((3000, 3))
    y = ((x[:, 0] < 0.5) & (x[:, 1] > 0.3) | (x[:, 2] > 0.9)).astype(float)
    model = quality.grow(x, y, np.array([-1, 0, 0]))
    assert ((model.score(x) > 0.5) == y).mean() > 0.95
    line = np.repeat(draw.random((200, 3)), 40, 0)
    line[:, 0] = np.tile(np.linspace(0, 1, 40), 200)
    assert (np.diff(model.margin(line).reshape(200, 40), axis=1) <= 1e-9).all()


def test_quality_keeps_good_documents(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    got = quality.judged(docs, labels.filter(half)).join(labels.filter(~half), "doc_id").collect()
    rest = [r for r in got if not r.base_failed]
    assert np.mean([r.kept == (r.quality == 1) for r in rest]) > 0.97


def test_simhash_against_all_pairs(spark):
    draw = random.Random(8)
    base = [[draw.choice("abcdefghijkl") + str(draw.randrange(50)) for _ in range(120)] for _ in range(8)]
    rows = []
    for i in range(300):
        w = list(draw.choice(base))
        for _ in range(draw.randrange(4)):
            w[draw.randrange(len(w))] = "Z" + str(draw.randrange(9))
        rows.append((i, draw.choice(["É", ""]) + " ".join(w)))
    rows += [(500, None), (501, " "), (502, "A b"), (503, "a B"), (3, "A b")]
    prints = {}
    for n, (i, t) in enumerate(rows):
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        s = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        prints[n] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    link = {n: {m for m in prints if (prints[n] ^ prints[m]).bit_count() <= 3} for n in prints}
    least, classes = {}, set()
    for n in prints:
        seen, todo = {n}, [n]
        while todo:
            new = link[todo.pop()] - seen
            seen |= new
            todo += new
        least[n] = min(rows[m][0] for m in seen)
        classes.add(frozenset(seen))
    expected = Counter((rows[n][0], f"{prints[n]:016x}", least[n]) for n in prints)
    assert len(set(least.values())) < len(set(prints.values()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, simhash.linked(df).collect())) == expected
    assert sorted(r.doc_id for r in simhash.keep_one(df).collect()) == sorted(
        min(rows[m][0] for m in c) for c in classes
    )


def test_simhash_replicas_are_not_broadcast(spark):
    """They were sized by the fingerprints they come from: 537 MB went through the driver at 0.5 GB."""
    links = simhash.links(spark.range(1000).select(F.xxhash64("id").alias("fp")))
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [anchor" in plan and "Broadcast" not in plan


def test_simhash_stored_prints_are_not_broadcast(spark):
    """Copies make the stored file small, not the rows."""
    df = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("one text for all").alias("text"))
    plan = simhash.linked(df)._jdf.queryExecution().executedPlan().toString()
    assert next(line for line in plan.splitlines() if "Join " in line).lstrip("+- ").startswith("SortMergeJoin [fp")


def test_simhash_tiles_and_anchors(spark):
    draw = np.random.default_rng(1)
    seeds = draw.integers(0, 2**64, 40, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in draw.choice(64, draw.integers(0, 4), replace=False)) for _ in range(3000)]
    prints = np.unique(np.array([int(draw.choice(seeds)) ^ f for f in flips], np.uint64))
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    found = simhash.links(df, tile=16).collect()
    number = {int(x): i for i, x in enumerate(prints.view(np.int64))}
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for r in found:
        i, j = number[r.a], number[r.b]
        assert np.bitwise_count(prints[i] ^ prints[j]) <= 3
        up[root(i)] = root(j)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 3):
            assert root(i) == root(int(j))


def plain_removal(rows, size=35):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[j : j + size]) for _, w in split for j in range(len(w) - size + 1))
    out = []
    for i, w in split:
        gone = {k for j in range(len(w) - size + 1) if seen[tuple(w[j : j + size])] > 1 for k in range(j, j + size)}
        left = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(left).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("part_bytes", [2_000, 10**7])
def test_repeats_against_all_windows(spark, part_bytes):
    draw = random.Random(5)
    base = [[draw.choice("abcdefgh") if k % 3 else str(draw.randrange(400)) for _ in range(300)] for k in range(6)]
    rows = []
    for n in range(200):
        w = []
        for _ in range(draw.randrange(1, 5)):
            b, s = draw.choice(base), draw.randrange(250)
            w += b[s : s + draw.randrange(5, 120)] + [str(draw.randrange(10**6)) for _ in range(draw.randrange(20))]
        if draw.random() < 0.3:
            w[draw.randrange(len(w))] = "X"
        rows.append((n, " ".join(w)))
    rows += [(1, rows[0][1]), (None, rows[3][1]), (900, None), (901, ""), (902, "a " * 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.deduplicated(df, part_bytes=part_bytes).drop("kept").collect()
    assert Counter(map(tuple, got)) == plain_removal(rows)


def test_repeats_on_documents(spark, folder):
    df = texts(spark, folder).select("doc_id", "text")
    got = substring_dedup.deduplicated(df, part_bytes=100_000).drop("kept").collect()
    assert Counter(map(tuple, got)) == plain_removal([tuple(r) for r in df.collect()])


def test_license_places(spark, folder):
    pieces = ["CC", "by", " ", " ", "-", "General Public", "license", "All ", "rights", "reserved", "é", "Ka", "x ", "\n"]
    rows = mixed_texts(9, pieces, 300) + [(r.doc_id + 1000, r.text) for r in texts(spark, folder).collect()]
    got = {r.doc_id: r for r in license_scan.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    phrases = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}
    for i, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = [(k, name) for k in range(len(w)) for name, p in phrases.items() if w[k : k + len(p)] == p]
        labels = ",".join(sorted({n for _, n in at}))
        where = [k for k, _ in at]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(w), len(at), min(where, default=None), max(where, default=None), labels), t
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def test_license_notices_with_changes(spark):
    rows = [(1, "x Released under, the MIT License. y"), (2, "Permission is hereby granted free of charge to any good person "
             "obtaining a copy of this software and associated documentation files"), (3, "the MIT license under the tree")]
    got = {r.doc_id: r.labels for r in license_scan.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "mit", 2: "mit", 3: ""}


def test_planted_items_are_found(spark, folder):
    docs, bench = texts(spark, folder), table(spark, folder, "benchmark")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()}
    items = [(r.item_id, re.findall(r"\w+", r.text.lower())) for r in bench.collect()]
    seen = defaultdict(set)
    for i, w in items:
        for k in range(len(w) - 7):
            seen[tuple(w[k : k + 8])].add((i, k))
    hits = defaultdict(set)
    for r in docs.collect():
        w = re.findall(r"\w+", r.text.lower())
        for k in range(len(w) - 7):
            for i, o in seen.get(tuple(w[k : k + 8]), ()):
                hits[r.doc_id, i].add(o)
    length = {i: len(w) - 7 for i, w in items}
    whole = {k for k, o in hits.items() if len(o) == length[k[1]]}
    assert whole <= got and all(len(hits[k]) >= 0.4 * length[k[1]] for k in got)


def test_changed_questions(spark, items):
    rows = [
        (1, "so Jim has 7 apples and gives 7 apples to Eve who then walks 9 miles to the big market in town."),
        (2, "so Jim has 7 apples and gives 8 apples to Eve who then walks 9 km to the big market in town."),
        (3, "Tom has 3 apples and gives 3 apples to Ann who then walks 5 km to the big market in town. " * 3),
        (4, "then walk the red line now, please"), (5, "she has 3 apples and none to give"),
    ]
    got = decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    assert {(r.doc_id, r.item_id, r.verbatim) for r in got} == {(1, 1, False), (3, 1, True), (4, 4, True)}


def reported(spark, questions, rows):
    items = spark.createDataFrame(list(enumerate(questions)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()}


ANNA = "Anna has 3 apples. Anna buys 4 more. How many apples does Anna have now?"
MET = "After school, Tom met Ann and Bob near the old mill, where Ann sold 12 eggs to Bob for 5 dollars."


def test_copies_in_any_case_and_without_marks(spark):
    rows = []
    for q in (ANNA, MET):
        rows += [q.upper(), q.lower(), q.title(), re.sub("[.,?]", "", q)]
    rows = ["Some words before it: " + r + " and some words after." for r in rows]
    assert reported(spark, [ANNA, MET], rows) == {(i, i // 4) for i in range(8)}


def test_names_changed_where_sentences_begin(spark):
    rows = [ANNA.replace("Anna", "Maria").replace("3", "5").replace("4", "2"),
            "Bill went home. Then he has seen 3 apples and how many of them does he have"]
    assert reported(spark, [ANNA], rows) == {(0, 0)}


def test_changed_values_may_coincide(spark):
    train = ("A train that is {} m long passes a pole in {} seconds and a bridge in {} seconds so how long is the bridge")
    baker = ("The baker bakes {} loaves before noon and {} loaves after noon and sells all of them for {} dollars each in the shop")
    items = [train.format(120, 6, 15), baker.format(3, 5, 7)]
    box = ("Tom puts {} plums and {} pears in a box and carries the box over a hill to the small house where {} cats and "
           "{} dogs of his old aunt live since she left the town by the sea some {} years ago")
    items.append(box.format(5, 5, 2, 7, 11))
    rows = [train.format(90, 9, 9), baker.format(4, 4, 7), baker.format(2, 3, 9), box.format(6, 8, 3, 9, 12)]
    # a value that stands for two drops its windows only
    assert reported(spark, items, rows) == {(0, 0), (1, 1), (2, 1), (3, 2)}


def test_short_and_unspaced_items_are_searched(spark):
    items = ["What is 12 + 37 * 4 - 9 / 3 + 18 ?", "Define entropy.", "小明有3个苹果，又买了4个，现在有几个？", "Name three noble gases"]
    rows = ["so what is 12 + 37 * 4 - 9 / 3 + 18? tell me", "please define entropy, he said", "问题：" + items[2] + "答案是7",
            "what is 12 - 37 * 9 + 18", "entropy", "name three noble gases now"]
    assert reported(spark, items, rows) == {(0, 0), (1, 1), (2, 2), (5, 3)}


def test_decontamination_with_a_shuffled_benchmark(spark, items, monkeypatch):
    df = spark.createDataFrame([(1, "Tom has 3 apples and gives 3 apples to Ann who then walks 5 km to the big market")], "doc_id long, text string")
    monkeypatch.setattr(decontam, "BROADCAST", 0)
    assert decontam.contaminated(df, items).count() == 1 and decontam.keep_clean(df, items).count() == 0


def test_mix_meets_targets(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "source")
    rows = mixing.taken(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
    total = sum(r.size for r in rows)
    assert sum(v[0].target for v in by.values()) == pytest.approx(1.5 * total)
    for v in by.values():
        assert sum(r.size for r in v) == v[0].source_size >= v[0].target / 2 - 1e-6
        # documents stand by size, so all but the last integer boundary balance out
        assert abs(sum(r.taken for r in v) - v[0].target) <= max(r.size for r in v)
    again = mixing.taken(docs.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in rows)


def test_targets_are_refilled_by_weight(spark):
    sizes = {"a": 10, "b": 400, "c": 90, None: 0, "é": 50}
    rate, open_, left = {}, dict(zip(["a", "b", "c", "é", None], [5, 2, 1, 5, 2])), 1.5 * sum(sizes.values())
    while True:
        share = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        full = [s for s, t in share.items() if t >= 2 * sizes[s]]
        if not full:
            rate |= share
            break
        for s in full:
            rate[s] = 2.0 * sizes[s]
            left -= rate[s]
            del open_[s]
    got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    assert {r.source: pytest.approx(r.target) for r in got} == rate


def test_mix_against_sql(spark, folder):
    import oracle

    con = oracle.connect(folder)
    name = "op4_mixing"
    assert oracle.compare(queries.QUERIES[name](spark, folder), con, queries.ORACLES[name]) is None


def test_stock_sentences_tell_nothing(spark):
    stock = "Read the following passage with care and then answer the question that stands below it."
    items = [f"{stock} Who saw the {a} {b} near the old {c}?" for a in ("red", "wet", "sad") for b in ("fox", "cow")
             for c in ("mill", "barn", "well")]
    rows = [f"note: {stock}"] * 20 + [f"well, {items[4].lower()}", items[7] + " ok", "nothing of it"]
    assert reported(spark, items, rows) >= {(20, 4), (21, 7)}
    assert {d for d, _ in reported(spark, items, rows)} == {20, 21}
    # an item that is the stock sentence is held by each
    assert reported(spark, [*items, stock], rows[:1]) == {(0, len(items))}


def test_spelled_and_joined_numbers(spark):
    train = "A train travels {} in {}. What is its speed and how long is the way to the next town?"
    rows = [train.format(a, b) for a, b in (("ninety-five miles", "three hours"), ("95 km", "2 hours"), ("Ninety-Five Miles", "THREE hours"))]
    assert reported(spark, [train.format("60 km", "2 hours")], rows) == {(0, 0), (1, 0), (2, 0)}


def test_decontamination_does_not_depend_on_partitions(spark, folder):
    docs, bench = texts(spark, folder), table(spark, folder, "benchmark")
    runs = [decontam.contaminated(docs.repartition(n), bench.repartition(n)).collect() for n in (1, 3, 8)]
    assert len({tuple(sorted(map(tuple, r))) for r in runs}) == 1 and runs[0]
