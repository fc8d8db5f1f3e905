"""Fixed schemas of the tables the library reads; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.functions.text import missing_to_null

_STRING, _INT, _LONG, _DOUBLE, _DATE = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType(),
)


def struct(**fields: T.DataType) -> T.StructType:
    """A nullable struct type; needs no running session, unlike a DDL string."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Column names, order and types of the publication table.
PUBLICATION = struct(
    title=_STRING, authors=_STRING, journal=_STRING, year=_INT, doi=_STRING, abstract=_STRING,
    keywords=_STRING, cited_by=_LONG, methodology=_STRING, dataset_used=_STRING,
    arxiv_id=_STRING, arxiv_categories=_STRING, published_date=_DATE, updated_date=_DATE,
    pdf_url=_STRING, arxiv_url=_STRING,
)

# One entry of an Atom feed as Spark's XML reader names it.
FEED_ENTRY = struct(
    id=_STRING, title=_STRING, summary=_STRING, published=_STRING, updated=_STRING,
    author=T.ArrayType(struct(name=_STRING)),
    category=T.ArrayType(struct(_term=_STRING)),
    link=T.ArrayType(struct(_href=_STRING, _title=_STRING)),
    **{"arxiv:journal_ref": _STRING, "arxiv:doi": _STRING},
)

# The run tables.
RUN = struct(
    run_id=_STRING, experiment_id=_STRING, run_name=_STRING, status=_INT,
    start_time=_LONG, end_time=_LONG, lifecycle_stage=_STRING,
)
RUN_PARAM = struct(run_id=_STRING, key=_STRING, value=_STRING)
RUN_METRIC = struct(run_id=_STRING, key=_STRING, ts=_LONG, value=_DOUBLE, step=_INT)

# The metrics file of one experiment.
EXPERIMENT_RESULT = struct(
    cross_validation=struct(
        mean_score=_DOUBLE, std_score=_DOUBLE, scores=T.ArrayType(_DOUBLE)
    ),
    test_metrics=struct(
        accuracy=_DOUBLE, precision=_DOUBLE, recall=_DOUBLE, f1_score=_DOUBLE, roc_auc=_DOUBLE
    ),
    model_info=struct(
        algorithm=_STRING, training_samples=_INT, test_samples=_INT, features=_INT, classes=_INT
    ),
    training_date=_STRING,
)


def null_missing_tokens(df: DataFrame) -> DataFrame:
    """Null the missing-value spellings in every string column."""
    return df.select(
        *[
            missing_to_null(f"`{f.name}`").alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
