"""Benchmark decontamination by template canonicalisation, in column expressions only.

Numbers, names and units become typed placeholders, so a question whose numbers or names
were exchanged still yields the same template. Texts have three forms, all without case
and marks: one in which names stay words, one in which they are typed, and one in which
every capitalised word is, since a name may begin a sentence. Every window of ``WINDOW``
words of a document is hashed in each and joined with the windows of all benchmark items.
On one diagonal (document offset less item offset) a value of the item stands for one
value of the document within its type. Windows that hold a value which stands for several
do not count, nor does a diagonal of which they are half or more; windows whose slots are
the item's own count in any case. A document is contaminated by an item if the windows
that count are at least ``COVER`` of the item's windows and one of its matched windows
tells something: it is held by at most ``STOCK`` templates, or the item has none held by
fewer.

The documents are read once: windows are unrolled and probed inside one stage and only
matches leave it, which are stored. The benchmark is broadcast if its windows, which are
counted first, are at most ``BROADCAST``; a larger one is joined by a shuffle whose hot
keys adaptive execution splits.

Null and empty texts match nothing. Items shorter than a window are searched by windows of
half its length. Items shorter than that, or without a window of which at least half is
plain words, are searched verbatim, by windows of their words as they stand. Characters of
scripts without blanks are words. Repeated documents are each reported, an item listed
twice with one text once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litsieve import session
from litsieve.llm import common

#: Words of a window.
WINDOW = 8
#: Share of an item's windows that makes a document contaminated.
COVER = 0.5
#: Templates that may hold a window which still tells something of each.
STOCK = 10
#: Rows that are broadcast at most, benchmark windows or digests: about 50 MB.
BROADCAST = 200_000

#: Private-use characters stand for the typed slots.
NUMBER, NAME, UNIT = "\uE000", "\uE001", "\uE002"

# Number words and units.
NUMBER_WORDS = (
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
    "hundred thousand million"
).split()
UNITS = (
    "km kilometers kilometres m meters metres cm mm mi miles mile ft feet inches kg kilograms g "
    "grams mg lb lbs pounds oz ounces l liters litres ml gallons s seconds minutes min hours hour "
    "days weeks months years dollars euros cents percent degrees mph kmh watts volts"
).split()

ONES = "one two three four five six seven eight nine".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()

#: Marks around a name, and around any other capitalised word, while forms are made.
_NAME_OPEN, _OPEN, _CLOSE = "\uE001", "\uE003", "\uE004"
_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"
#: The same without the marks.
_OWN = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F\uE001\uE003\uE004]"
_CAPITAL = "[A-Z\\u00C0-\\u00D6\\u00D8-\\u00DE]"
_CAPITALISED = f"{_CAPITAL}(?<!{_WORD}{_CAPITAL})(?:{_WORD}|['-])*"
#: A capitalised word is a name unless a sentence may begin with it.
_NAMES = f"{_OPEN}(?<=(?:{_OWN}{_CLOSE}?|[,;])\\x20{_OPEN})"
_NUMBERS = "[0-9]+(?:[.,:/][0-9]+)*"
#: Number words with all that may follow them in one word, by their first letter: tried only
#: after what parts words, which is kept.
_INITIALS = sorted({w[0] for w in NUMBER_WORDS})
_COMPOUND = {w: f"{w}(?:-(?:{'|'.join(ONES)}))?" if w in TENS else w for w in NUMBER_WORDS}
_SPELLED = "([\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F\uE001\uE003\uE004])" + (
    f"(?=[{''.join(_INITIALS)}{''.join(_INITIALS).upper()}])(?:"
) + "|".join(
    f"[{c}{c.upper()}](?i:{'|'.join(v[1:] for w, v in _COMPOUND.items() if w[0] == c)})" for c in _INITIALS
) + f")(?!{_OWN})"
_UNITS = f"({NUMBER}{_CLOSE}?\\x20[{_NAME_OPEN}{_OPEN}]?)(?i:{'|'.join(UNITS)})(?!{_OWN})"
_ATTACHED = f"([0-9])(?=(?i:{'|'.join(UNITS)})(?!{_WORD}))"
_MARKS = "[\\x00-\\x1F\\x21-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: A blank that no word follows, with the marks that stand there.
_LOOSE = f"\\x20(?:{_MARKS}+)?(?=\\x20|$)"
#: Characters of scripts without blanks are words each; their marks part words.
_UNSPACED = (
    "[\\u0E00-\\u0EFF\\u1000-\\u109F\\u1780-\\u17FF\\u3040-\\u30FF\\u3400-\\u4DBF\\u4E00-\\u9FFF"
    "\\uF900-\\uFAFF\\uFF66-\\uFF9F\\x{20000}-\\x{3FFFF}]"
)
_PARTING = "[\\u3000-\\u303F\\uFF01-\\uFF0F\\uFF1A-\\uFF20\\uFF3B-\\uFF40\\uFF5B-\\uFF65]"
#: Sentence marks at either end of a word.
_SENTENCE = "[.,;:!?\"'()\\[\\]{}]+(?=\\x20|$)|(?<![^\\x20])[.,;:!?\"'()\\[\\]{}]+"

#: Forms of a document: names as words, names typed, every capitalised word typed.
FORMS = ("plain", "canon", "caps")


def _spaced(df: DataFrame) -> DataFrame:
    """``text`` with one kind of blank, units parted from numbers, unspaced scripts parted.

    Each step is a column of its own, since the next one uses it several times.
    """
    text = F.coalesce("text", F.lit(""))
    for blank in "\t\n\v\f\r":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    df, text = df.withColumn("text", text), F.col("text")
    df = df.withColumn("text", F.when(text.rlike("[0-9]"), F.regexp_replace(text, _ATTACHED, "$1 ")).otherwise(text))
    parted = F.regexp_replace(F.regexp_replace(text, _PARTING, " "), f"({_UNSPACED})", " $1 ")
    wide = F.octet_length(text) > F.length(text)
    return df.withColumn("text", F.when(wide & text.rlike(_UNSPACED), parted).otherwise(text))


def canonical(df: DataFrame) -> DataFrame:
    """Put the words of all ``FORMS`` and ``raw``, what stands there, for ``text``.

    Words are cut at blanks; marks are removed and words of marks alone disappear, before
    anything else, so that a word has one place in all forms. A unit attached to its number
    counts as a word of its own. Capitalised words are marked where they stand; numbers,
    units, marks and case are seen to once, and each form drops or types what is marked.
    """
    def without(text: Column, *marks: str) -> Column:
        for m in marks:
            text = F.replace(text, F.lit(m), F.lit(""))
        return text

    def typed(text: Column, marks: str) -> Column:
        return F.regexp_replace(text, f"[{marks}][^{_CLOSE}\\x20]*{_CLOSE}", NAME)

    df = _spaced(df)
    # every word has a blank before it
    df = df.withColumn("text", F.regexp_replace(F.concat(F.lit(" "), "text"), _LOOSE, ""))
    marked = F.regexp_replace("text", _CAPITALISED, f"{_OPEN}$0{_CLOSE}")
    marked = F.regexp_replace(marked, _NAMES, _NAME_OPEN)
    marked = F.regexp_replace(F.regexp_replace(marked, _NUMBERS, NUMBER), _SPELLED, f"$1{NUMBER}")
    df = df.withColumn("marked", marked)
    units = F.regexp_replace("marked", _UNITS, f"$1{UNIT}")
    marked = F.when(F.contains("marked", F.lit(NUMBER)), units).otherwise(F.col("marked"))
    df = df.withColumn("marked", F.ltrim(F.lower(F.regexp_replace(marked, _MARKS, ""))))
    forms = {
        "plain": without(F.col("marked"), _NAME_OPEN, _OPEN, _CLOSE),
        "canon": without(typed(F.col("marked"), _NAME_OPEN), _OPEN, _CLOSE),
        "caps": typed(F.col("marked"), _NAME_OPEN + _OPEN),
    }
    return df.select(
        *[c for c in df.columns if c not in ("text", "marked")],
        *[F.split(v, " ").alias(f) for f, v in forms.items()], F.split(F.ltrim("text"), " ").alias("raw"),
    )


def bare_words(df: DataFrame) -> DataFrame:
    """Put ``words`` for ``text``: as they stand, in lower case, without sentence marks around them."""
    words = F.split(F.regexp_replace(F.lower("text"), _SENTENCE, ""), "\\x20")
    return _spaced(df).withColumn("words", F.array_remove(words, "")).drop("text")


def _value(word: Column) -> Column:
    return F.lower(F.regexp_replace(word, _MARKS, ""))


def _key(words: str, at: str, size: int) -> Column:
    """The hash of ``size`` words from a place on, NULL where fewer are left."""
    words_at = [F.get(words, F.col(at) + j) for j in range(size)]
    return F.when(F.col(at) + size <= F.size(words), F.xxhash64(*words_at))


def _items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, text, forms, raw, size): each item with the window size it is searched by.

    ``names`` is a form of items alone: words that are names anywhere in the item are typed
    wherever they stand capitalised.
    """
    rows = benchmark.select(
        common.field("item_id").alias("item_id"), common.text_of().alias("text")
    ).distinct()
    rows = rows.withColumns({"item": F.xxhash64("item_id", "text"), "whole": F.col("text")})
    rows = canonical(rows).withColumnRenamed("whole", "text")
    rows = rows.withColumn("known", F.filter("plain", lambda w, i: F.get("canon", i) == NAME))
    named = lambda w, i: (F.get("caps", i) == NAME) & F.array_contains("known", F.get("plain", i))
    rows = rows.withColumn("names", F.transform("canon", lambda w, i: F.when(named(w, i), NAME).otherwise(w)))
    size = F.when(F.size("canon") >= WINDOW, WINDOW).when(F.size("canon") >= WINDOW // 2, WINDOW // 2)
    return rows.withColumn("size", size).drop("known")


def item_windows(items: DataFrame) -> DataFrame:
    """(key, item, item_id, size, offset, total, values, slots, telling): windows of items.

    ``values`` are the words in the text, ``slots`` the places that are placeholders and
    their types. A window is searched in every form, if it is at least half plain words
    with names typed; ``total`` counts it once. Not ``telling`` is one that more than
    ``STOCK`` templates hold, in an item that has windows held by fewer.
    """
    template = F.xxhash64("canon").alias("template")
    items = items.select("*", template, F.posexplode("canon").alias("offset", "word"))
    found = None
    for size in (WINDOW, WINDOW // 2):

        def slots(form: str) -> Column:
            part = F.slice(form, F.col("offset") + 1, F.lit(size))
            typed = lambda w, i: F.when(w.isin(NUMBER, NAME, UNIT), F.struct(i.alias("at"), w.alias("kind")))
            return F.filter(F.transform(part, typed), lambda i: i.isNotNull())

        for form in (*FORMS, "names"):
            rows = items.filter(F.col("size") == size).select(
                _key(form, "offset", size).alias("key"), "item", "item_id", "template", "size", "offset",
                slots(form).alias("slots"), F.size(slots("canon")).alias("least"),
                F.slice("raw", F.col("offset") + 1, F.lit(size)).alias("values"),
            ).filter(F.col("key").isNotNull() & (F.size("slots") <= size // 2) & (F.col("least") <= size // 2))
            found = rows if found is None else found.union(rows)
    found = session.materialise(found.drop("least").distinct(), "item-windows")
    held = found.groupBy("key").agg(F.count_distinct("template").alias("held"))
    item = Window.partitionBy("item")
    found = found.drop("template").join(held, "key").withColumns(
        {"total": F.size(F.collect_set("offset").over(item)), "fewest": F.min("held").over(item)}
    )
    return found.withColumn("telling", F.col("held") <= F.greatest(F.lit(STOCK), "fewest")).drop("held", "fewest")


def _hits(texts: DataFrame, keys: DataFrame, sizes: list[int]) -> DataFrame:
    """(row, pos, key, words): windows of documents that items have as well.

    A window is looked up once for each form in which it differs. The outer form of the
    generators keeps Spark from inferring a filter on the hashes, which would compute them
    a second time; the join drops the empty rows. Hashes are taken of the unrolled rows, by
    expressions that are compiled, unlike functions over arrays.
    """
    rows = texts.select("row", "raw", *FORMS, F.posexplode_outer("plain").alias("pos", "word"))
    hashes = [_key(f, "pos", s).alias(f"{f}_{s}") for s in sizes for f in FORMS]
    rows, once = rows.select("row", "raw", "pos", *hashes), []
    for s in sizes:
        plain, canon, caps = (F.col(f"{f}_{s}") for f in FORMS)
        once += [plain, F.when(canon != plain, canon), F.when((caps != plain) & (caps != canon), caps)]
    rows = rows.select("row", "raw", "pos", F.explode_outer(F.array(*once)).alias("key"))
    few = keys.count() <= BROADCAST
    rows = rows.join(F.broadcast(keys) if few else keys, "key")
    return rows.select("row", "pos", "key", F.slice("raw", F.col("pos") + 1, F.col("size")).alias("words"))


def _aligned(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """Matched windows: row, item, diagonal, offset and the pairs of slot values.

    Windows that tell nothing are joined only for documents and items that share a telling
    one, so a sentence that is stock to thousands of items yields no pair by itself.
    """
    few = windows.count() <= BROADCAST
    near = lambda df: F.broadcast(df) if few else df
    telling, stock = windows.filter("telling").drop("telling"), windows.filter("not telling").drop("telling")
    rows = hits.join(near(telling), "key")
    if stock.limit(1).count():
        pairs = rows.select("row", "item").distinct().join(near(stock), "item")
        rows = rows.unionByName(hits.join(pairs, ["row", "key"]))
    # a value is marked by its type, so that types are told apart
    pairs = F.transform(
        "slots",
        lambda i: F.struct(
            F.concat(i["kind"], _value(F.get("values", i["at"]))).alias("item"),
            F.concat(i["kind"], _value(F.get("words", i["at"]))).alias("doc"),
        ),
    )
    rows = rows.select(
        "row", "item", "item_id", "total", (F.col("pos") - F.col("offset")).alias("diagonal"), "offset",
        pairs.alias("pairs"),
    )
    return rows.withColumn("same", F.forall("pairs", lambda p: p["item"] == p["doc"]))


def _verbatim(docs: DataFrame, rest: DataFrame) -> DataFrame | None:
    """Matched windows, as ``_aligned`` has them, of the words as they stand of other items."""
    words = bare_words(rest.select("item", "item_id", "text")).filter("size(words) > 0")
    n = F.size("words")
    size = F.when(n >= WINDOW, WINDOW).when(n >= WINDOW // 2, WINDOW // 2).otherwise(n)
    words = session.materialise(words.withColumn("size", size), "bare-items")
    found = None
    for size in sorted(r.size for r in words.select(F.col("size").alias("size")).distinct().collect()):
        keys = words.filter(F.col("size") == size)
        keys = keys.select("item", "item_id", "words", F.posexplode("words").alias("offset", "word"))
        keys = keys.select(
            "item", "item_id", (F.size("words") - size + 1).alias("total"), "offset", _key("words", "offset", size).alias("key")
        ).filter("key is not null")
        texts = bare_words(docs.select("row", "text"))
        rows = texts.select("row", "words", F.posexplode_outer("words").alias("pos", "word"))
        rows = rows.select("row", "pos", _key("words", "pos", size).alias("key"))
        rows = rows.join(F.broadcast(keys) if keys.count() <= BROADCAST else keys, "key").select(
            "row", "item", "item_id", "total", (F.col("pos") - F.col("offset")).alias("diagonal"), "offset",
            F.array().cast("array<struct<item:string,doc:string>>").alias("pairs"), F.lit(True).alias("same"),
        )
        found = rows if found is None else found.union(rows)
    return found


def matches(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """(row, item_id, matched, total, cover, verbatim) of contaminated document rows.

    ``docs`` has row, which tells rows apart, and text.
    """
    items = session.materialise(_items(benchmark), "items")
    windows = session.materialise(item_windows(items), "item-windows")
    sizes = [r.size for r in windows.select("size").distinct().collect()] or [WINDOW]
    hits = _hits(canonical(docs), windows.select("key", "size").distinct(), sizes)
    found = _aligned(session.materialise(hits, "benchmark-hits"), windows)
    others = _verbatim(docs, items.join(windows.select("item").distinct(), "item", "left_anti"))
    found = found if others is None else found.union(others)
    # an offset occurs at most once for each form on a diagonal
    lines = found.groupBy("row", "item", "item_id", "total", "diagonal").agg(
        F.collect_list(F.struct("offset", "pairs", "same")).alias("hits")
    )
    lines = lines.withColumn("stands", F.col("hits.pairs")).withColumn("stands", F.array_distinct(F.flatten("stands")))
    lines = lines.withColumn("stands", F.col("stands.item"))
    split = F.filter(
        F.array_distinct("stands"), lambda v: F.size(F.filter("stands", lambda w: w == v)) > 1
    )
    lines = lines.withColumn("split", split)
    free = lambda h: ~F.exists(h["pairs"], lambda p: F.array_contains("split", p["item"]))
    lines = lines.withColumn("free", F.filter("hits", free))
    most = F.size(F.array_distinct("free.offset")) * 2 > F.size(F.array_distinct("hits.offset"))
    # verbatim windows count in any case
    own = F.filter("hits", lambda h: h["same"])
    lines = lines.withColumn("hit", F.explode(F.when(most, F.concat("free", own)).otherwise(own)))
    out = lines.groupBy("row", "item", "item_id", "total").agg(
        F.count_distinct("hit.offset").alias("matched"), F.min("hit.same").alias("verbatim")
    )
    out = out.withColumn("cover", F.col("matched") / F.col("total")).filter(F.col("cover") >= cover)
    return out.select("row", "item_id", "matched", "total", "cover", "verbatim")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document row and item: doc_id, item_id and the evidence."""
    ids = F.struct(F.monotonically_increasing_id().alias("n"), common.field("doc_id").alias("doc_id"))
    rows = docs.select(ids.alias("row"), common.text_of().alias("text"))
    return matches(rows, benchmark).select(
        F.col("row.doc_id").alias("doc_id"), "item_id", "matched",
        F.col("total").alias("item_windows"), "cover", "verbatim",
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no item contaminates, with all their columns.

    The verdict rests on the text alone, so documents are dropped by its digest. The
    digests of contaminated texts are stored and counted; few are broadcast, more are
    joined by a shuffle.
    """
    digest = F.md5(common.text_of().cast("binary"))
    ids = F.struct(F.monotonically_increasing_id().alias("n"), digest.alias("digest"))
    rows = docs.select(ids.alias("row"), common.text_of().alias("text"))
    bad = matches(rows, benchmark).select(F.col("row.digest").alias("digest")).distinct()
    bad = session.materialise(bad, "contaminated")
    text = F.coalesce(F.col("doc").getField("text"), F.lit(""))
    whole = common.packed(docs).withColumn("digest", F.md5(text.cast("binary")))
    few = bad.count() <= BROADCAST
    return common.unpacked(whole.join(F.broadcast(bad) if few else bad, "digest", "left_anti"), docs)
