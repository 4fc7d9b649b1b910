"""Bag-of-n-gram features as DataFrame jobs.

A term is kept only if at least a share ``min_df`` of the documents hold it, so
a vocabulary has at most (mean distinct terms per document) / min_df entries,
however many documents there are. How it is joined is left to its measured size.
Texts are cut into words once: the words are stored in the shared folder, and
every later step reads them from there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from litsieve.session import materialise


# Two or more word characters. Fixed value.
FEATURE_TOKEN = r"\b\w\w+\b"

# English function words, a general default. A vectoriser's own list is a
# parameter: pass it, or read it with ``read_word_list``.
STOP_WORDS: tuple[str, ...] = tuple(
    """
    a about above after again against all also am an and any are as at be because been before
    being below between both but by can cannot could did do does doing down during each few for
    from further had has have having he her here hers herself him himself his how i if in into is
    it its itself just me more most my myself no nor not now of off on once only or other our ours
    ourselves out over own same she should so some such than that the their theirs them themselves
    then there these they this those through to too under until up very was we were what when
    where which while who whom why will with would you your yours yourself yourselves
    """.split()
)


def read_word_list(spark: SparkSession, path: str, limit: int = 10_000) -> list[str]:
    """A word list, one word per line; refuses a file that is not a short list."""
    rows = spark.read.text(path).select(F.trim("value").alias("w")).filter("w != ''").take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"{path} holds more than {limit} words")
    return [r.w for r in rows]


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(FEATURE_TOKEN), F.lit(0))


def without_stop_words(words: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    stops = list(stop_words)
    return F.filter(words, lambda w: ~w.isin(stops)) if stops else words


def bigrams(words: Column) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(
        F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )


def with_words(df: DataFrame, text: str = "text",
               stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """Add ``words``: the tokens that are no stop words, in order."""
    return df.withColumn("words", without_stop_words(tokens(F.col(text)), stop_words))


def with_terms(df: DataFrame) -> DataFrame:
    """Add ``terms``: the words, then their neighbouring pairs."""
    return df.withColumn("terms", F.concat("words", bigrams(F.col("words"))))


#: Frequent words that tasks are given as a list, at most; more of them are joined.
LISTED = 1 << 20


def _entries(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(row, word) of all words of a list column, in order."""
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(words), dtype=np.int64), sizes), words.flatten()


def _codes(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Place of each word among the known ones, -1 if it is not one of them."""
    return pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _neighbours(row: np.ndarray, code: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, first * n + second) of neighbouring known words."""
    at = np.flatnonzero((row[1:] == row[:-1]) & (code[1:] >= 0) & (code[:-1] >= 0))
    return row[at], code[at] * n + code[at + 1]


def _distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct entries, by row."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, df) of the words of each batch."""
    for batch in batches:
        row, words = _entries(batch.column("words"))
        if not len(words):
            continue
        coded = words.dictionary_encode()
        code = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)
        _, code = _distinct(row[code >= 0], code[code >= 0])
        df = np.bincount(code, minlength=len(coded.dictionary)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(df)], ["term", "df"])


def _count_pairs(frequent: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(first, second, df) of the neighbouring frequent words of each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(frequent, pa.string())
        for batch in batches:
            row, words = _entries(batch.column("words"))
            row, pair = _neighbours(row, _codes(words, known), max(len(known), 1))
            pair, df = np.unique(_distinct(row, pair)[1], return_counts=True)
            parts = known.take(pa.array(pair // max(len(known), 1))), known.take(pa.array(pair % max(len(known), 1)))
            yield pa.RecordBatch.from_arrays([*parts, pa.array(df.astype(np.int64))], ["first", "second", "df"])

    return run


def vocabulary(df: DataFrame, min_df: float = 0.02, max_df: float = 0.75,
               stored: bool = False) -> DataFrame:
    """(term, df) of the words and pairs within the document-frequency bounds.

    A pair cannot be more frequent than either of its words, so pairs of a rare
    word are dropped where they are made: almost all distinct pairs never reach
    the shuffle. Both are counted per batch of documents before it. ``stored`` says
    that ``df`` is cheap to read again.
    """
    df = df.select("words") if stored else materialise(df.select("words"), "words")
    documents = df.agg(F.count("*")).scalar()
    least, most = F.lit(min_df) * documents, F.lit(max_df) * documents

    words = (
        df.mapInArrow(_count_words, "term string, df bigint")
        .groupBy("term").agg(F.sum("df").alias("df"))
        .filter(F.col("df") >= least)
    )
    words = materialise(words, "frequent")
    listed = [r.term for r in words.select("term").take(LISTED + 1)]
    pairs = _listed_pairs(df, listed) if len(listed) <= LISTED else _joined_pairs(df, words.select("term"))
    pair_counts = pairs.filter(F.col("df") >= least).select(
        F.concat_ws(" ", "first", "second").alias("term"), "df"
    )
    return words.unionByName(pair_counts).filter(F.col("df") <= most)


def _listed_pairs(df: DataFrame, frequent: list[str]) -> DataFrame:
    """(first, second, df) of pairs of frequent words, which every task knows."""
    pairs = df.mapInArrow(_count_pairs(frequent), "first string, second string, df bigint")
    return pairs.groupBy("first", "second").agg(F.sum("df").alias("df"))


def _joined_pairs(df: DataFrame, frequent: DataFrame) -> DataFrame:
    """The same for any number of frequent words."""
    # distinct pairs per document, as (first, second)
    pairs = df.select(F.explode(F.array_distinct(bigrams(F.col("words")))).alias("pair")).select(
        F.substring_index("pair", " ", 1).alias("first"),
        F.substring_index("pair", " ", -1).alias("second"),
    )
    for side in ("first", "second"):
        pairs = pairs.join(frequent.withColumnRenamed("term", side), side, "left_semi")
    return pairs.groupBy("first", "second").agg(F.count("*").alias("df"))


class _Matcher:
    """Which terms of a vocabulary the documents hold."""

    def __init__(self, terms: list[str]):
        self.terms = terms

    def entries(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, place of the term) of a list column, by row."""
        if not hasattr(self, "known"):
            self._prepare()
        row, words = _entries(words)
        code = _codes(words, self.known)
        place = self.word[code]
        pair_row, pair = _neighbours(row, code, len(self.known))
        at = np.minimum(np.searchsorted(self.pairs, pair), max(len(self.pairs) - 1, 0))
        hit = self.pairs[at] == pair if len(self.pairs) else np.zeros(len(pair), bool)
        there = (code >= 0) & (place >= 0)
        rows = np.concatenate([row[there], pair_row[hit]])
        return _distinct(rows, np.concatenate([place[there], self.pair_place[at[hit]]]))

    def _prepare(self) -> None:
        parts = [t.split(" ") for t in self.terms]
        number: dict[str, int] = {}
        for part in parts:
            for word in part:
                number.setdefault(word, len(number))
        # the last place is for words that are not known
        self.word = np.full(len(number) + 1, -1, np.int64)
        pairs = []
        for place, part in enumerate(parts):
            if len(part) == 1:
                self.word[number[part[0]]] = place
            else:
                pairs.append((number[part[0]] * len(number) + number[part[1]], place))
        pairs.sort()
        self.pairs = np.array([p for p, _ in pairs], np.int64)
        self.pair_place = np.array([p for _, p in pairs], np.int64)
        self.known = pa.array(list(number), pa.string())


#: Rows of one batch of long-form vectors.
_LONG = 1 << 17


def _long_form(terms: list[str], keep: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(kept columns, term), one row per document and term it holds."""
    match = _Matcher(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(terms, pa.string())
        for batch in batches:
            row, place = match.entries(batch.column("words"))
            for a in range(0, len(row), _LONG):
                own, held = pa.array(row[a : a + _LONG]), pa.array(place[a : a + _LONG])
                columns = [batch.column(c).take(own) for c in keep] + [names.take(held)]
                yield pa.RecordBatch.from_arrays(columns, [*keep, "term"])

    return run


def _counted(terms: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(term, n_docs, n_pos, n_neg) of the documents of a task, ``_pos`` being their class."""
    match = _Matcher(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, len(terms)), np.int64)
        for batch in batches:
            row, place = match.entries(batch.column("words"))
            for out, flag in zip(sums, (None, True, False)):
                own = place if flag is None else place[
                    pc.fill_null(pc.equal(batch.column("_pos"), flag), False).to_numpy(zero_copy_only=False)[row]
                ]
                out += np.bincount(own, minlength=len(terms))
        held = np.flatnonzero(sums[0])
        columns = [pa.array(terms, pa.string()).take(pa.array(held)), *(pa.array(s[held]) for s in sums)]
        yield pa.RecordBatch.from_arrays(columns, ["term", "n_docs", "n_pos", "n_neg"])

    return run


def _vocabulary_list(df: DataFrame, min_df: float, max_df: float) -> tuple[DataFrame, list[str] | None]:
    """The terms of stored words, stored, and as a list unless there are too many."""
    vocab = materialise(vocabulary(df, min_df, max_df, stored=True).select("term"), "vocabulary")
    terms = [r.term for r in vocab.take(LISTED + 1)]
    return vocab, terms if len(terms) <= LISTED else None


def _joined_vectors(df: DataFrame, vocab: DataFrame, *keep: str) -> DataFrame:
    rows = with_terms(df).select(*keep, F.explode(F.array_distinct("terms")).alias("term"))
    return rows.join(vocab, "term", "left_semi").select(*keep, "term")


def term_vectors(df: DataFrame, *keep: str, min_df: float = 0.02,
                 max_df: float = 0.75) -> DataFrame:
    """Binary document vectors in long form: (kept columns, term)."""
    df = materialise(df.select(*keep, "words"), "words")
    vocab, terms = _vocabulary_list(df, min_df, max_df)
    if terms is None:
        return _joined_vectors(df, vocab, *keep)
    schema = StructType([*df.select(*keep).schema.fields, StructField("term", StringType())])
    return df.mapInArrow(_long_form(terms, keep), schema)


def feature_counts(df: DataFrame, positive: Column, min_df: float = 0.02,
                   max_df: float = 0.75) -> DataFrame:
    """(term, n_docs, n_pos, n_neg) of the vocabulary: documents holding the term, by class."""
    df = materialise(df.select(positive.alias("_pos"), "words"), "words")
    vocab, terms = _vocabulary_list(df, min_df, max_df)
    if terms is None:
        return _joined_vectors(df, vocab, "_pos").groupBy("term").agg(
            F.count("*").alias("n_docs"),
            F.count_if("_pos").alias("n_pos"),
            F.count_if(~F.col("_pos")).alias("n_neg"),
        )
    counts = df.mapInArrow(_counted(terms), "term string, n_docs bigint, n_pos bigint, n_neg bigint")
    return counts.groupBy("term").agg(*[F.sum(c).alias(c) for c in ("n_docs", "n_pos", "n_neg")])


class TermVectorizer(Estimator):
    """Binary vectors over the alphabetical vocabulary of column ``words``.

    The fitted model reads ``terms``. The vocabulary is checked against
    ``limit`` before anything but that many terms reaches the driver.
    """

    minDF = Param(Params._dummy(), "minDF", "least share of documents", TypeConverters.toFloat)
    maxDF = Param(Params._dummy(), "maxDF", "largest share of documents", TypeConverters.toFloat)
    limit = Param(Params._dummy(), "limit", "most terms allowed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, minDF: float = 0.02, maxDF: float = 0.75, limit: int = 1 << 20):
        super().__init__()
        self._setDefault(minDF=0.02, maxDF=0.75, limit=1 << 20)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> CountVectorizerModel:
        limit = self.getOrDefault("limit")
        bounds = self.getOrDefault("minDF"), self.getOrDefault("maxDF")
        vocab = vocabulary(dataset, *bounds, stored=True)
        rows = vocab.select("term").orderBy("term").take(limit + 1)
        if not 0 < len(rows) <= limit:
            raise ValueError(f"vocabulary is empty or exceeds {limit} terms; change minDF")
        return CountVectorizerModel.from_vocabulary(
            [r.term for r in rows], inputCol="terms", outputCol="features"
        ).setBinary(True)


def with_class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Add ``weight`` = n / (2 n_class), which balances two classes."""
    sizes = df.agg(
        F.struct(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("pos"))
    ).scalar()
    n, pos = F.col("_sizes.n"), F.col("_sizes.pos")
    return (
        df.withColumn("_sizes", sizes)
        .withColumn("weight", n / (2 * F.when(F.col(label) == 1, pos).otherwise(n - pos)))
        .drop("_sizes")
    )
