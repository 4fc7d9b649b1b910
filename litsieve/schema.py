"""Sample classes: field lists, class names and the positive class."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

FIELD_SEP = "|"
RECORD_END = ";;"

# Field names and their order are the record format. Fixed values.
_TEXT = ("title", "abstract", "extractedText")
_STATUS = ("apStatus", "gxdStatus", "goStatus", "tumorStatus", "qtlStatus")

PREDICTION_FIELDS = (
    "pubmed", "predClass", "confidence", "absValue", "trueClass", "fpFn",
    "creationDate", "year", "isReview", "refType", "suppStatus",
    "ap", "gxd", "go", "tumor", "qtl", "journal", "abstractLen", "textLen",
)


@dataclass(frozen=True)
class SampleType:
    name: str
    fields: tuple[str, ...]
    class_names: tuple[str, str]
    positive: int
    extra_info: tuple[str, ...] = ()

    @property
    def positive_class(self) -> str:
        return self.class_names[self.positive]

    @property
    def negative_class(self) -> str:
        return self.class_names[1 - self.positive]

    @property
    def classified(self) -> bool:
        return "knownClassName" in self.fields

    @property
    def header(self) -> str:
        return FIELD_SEP.join(self.fields)

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f, T.StringType()) for f in self.fields])

    def check_field(self, name: str) -> str:
        if name not in self.fields:
            raise KeyError(name)
        return name

    def is_positive(self, label: str | Column = "knownClassName") -> Column:
        label = F.col(label) if isinstance(label, str) else label
        return label == F.lit(self.positive_class)

    def y(self, label: str | Column = "knownClassName") -> Column:
        """Class index of the label (NULL for an unknown name)."""
        label = F.col(label) if isinstance(label, str) else label
        return (
            F.when(label == self.class_names[0], F.lit(0))
            .when(label == self.class_names[1], F.lit(1))
        )

    def conform(self, df: DataFrame) -> DataFrame:
        """Keep this type's fields as strings; missing ones become ''."""
        present = set(df.columns)
        return df.select(
            [
                F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f)
                if f in present
                else F.lit("").alias(f)
                for f in self.fields
            ]
        )


PRIM_TRIAGE = SampleType(
    "PrimTriageClassifiedSample",
    ("knownClassName", "ID", "creationDate", "year", "isReview", "refType",
     "suppStatus", *_STATUS, "journal", *_TEXT),
    ("discard", "keep"),
    1,
    ("creationDate", "year", "isReview", "refType", "suppStatus", *_STATUS,
     "journal", "abstractLen", "textLen"),
)

PRIM_TRIAGE_UNCLASSIFIED = SampleType(
    "PrimTriageUnClassifiedSample", ("ID", *_TEXT), ("discard", "keep"), 1
)

CUR_GROUP = SampleType(
    "CurGroupClassifiedSample",
    ("knownClassName", "ID", "creationDate", "year", "discardKeep", "isReview",
     "refType", "suppStatus", *_STATUS, "journal", *_TEXT),
    ("selected", "unselected"),
    0,
    ("creationDate", "year", "discardKeep", "isReview", "refType", "suppStatus",
     *_STATUS, "journal", "abstractLen", "textLen"),
)

CUR_GROUP_UNCLASSIFIED = SampleType(
    "CurGroupUnClassifiedSample", ("ID", *_TEXT), ("selected", "unselected"), 0
)

CLASSIFIED_REF = SampleType(
    "ClassifiedRefSample", ("knownClassName", "ID", "journal", *_TEXT), ("no", "yes"), 1
)

REF = SampleType("RefSample", ("ID", *_TEXT), ("no", "yes"), 1)

SAMPLE_TYPES = {
    t.name: t
    for t in (PRIM_TRIAGE, PRIM_TRIAGE_UNCLASSIFIED, CUR_GROUP,
              CUR_GROUP_UNCLASSIFIED, CLASSIFIED_REF, REF)
}


def sample_type(name: str) -> SampleType:
    try:
        return SAMPLE_TYPES[name]
    except KeyError:
        raise ValueError(f"invalid sample class name {name!r}") from None


def validate_class(df: DataFrame, kind: SampleType, label: str = "knownClassName",
                   quarantine: bool = False) -> DataFrame:
    """Strip one leading ';' from the label and check it against the class names.

    An unknown name fails the job, or with ``quarantine`` sets the reject columns.
    """
    cleaned = F.regexp_replace(F.col(label), "^;", "")
    known = F.coalesce(cleaned.isin(*kind.class_names), F.lit(False))
    reason = F.concat(F.lit("invalid class name: "), F.coalesce(cleaned, F.lit("")))
    if quarantine:
        return df.withColumns(
            {label: cleaned, "reject": ~known,
             "reject_reason": F.when(known, F.lit("")).otherwise(reason)}
        )
    return df.withColumn(label, F.when(known, cleaned).otherwise(F.raise_error(reason)))


def set_reject(df: DataFrame, condition: Column, reason: str | Column) -> DataFrame:
    """Mark rows as rejected, keeping the reason given first."""
    reason = F.lit(reason) if isinstance(reason, str) else reason
    hit = F.coalesce(condition, F.lit(False))
    if "reject" in df.columns:
        already = F.col("reject")
        return df.withColumns(
            {"reject": already | hit,
             "reject_reason": F.when(already, F.col("reject_reason"))
                               .when(hit, reason).otherwise(F.lit(""))}
        )
    return df.withColumns(
        {"reject": hit, "reject_reason": F.when(hit, reason).otherwise(F.lit(""))}
    )


def omit_rejects(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("reject"))
