"""Fixed schemas of the tables this package reads and writes."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

IDS = ArrayType(IntegerType())

MANIFEST = StructType(
    [
        StructField("tex", StringType()),
        StructField("year", IntegerType()),
        StructField("month", IntegerType()),
    ]
)

VOCAB = StructType([StructField("token", StringType()), StructField("id", IntegerType())])

BLOCK = StructType(
    [
        StructField("split", StringType()),
        StructField("year", IntegerType()),
        StructField("month", IntegerType()),
        StructField("doc_id", LongType()),
        StructField("chunk_idx", IntegerType()),
        StructField("input_ids", IDS),
        StructField("attention_mask", IDS),
        StructField("num_chunks", IntegerType()),
    ]
)

EVAL_RECORD = StructType(
    [
        StructField("dataset", StringType()),
        StructField("batch_id", LongType()),
        StructField("n", LongType()),
        StructField("loss", DoubleType()),
        StructField("preds", IDS),
        StructField("labels", IDS),
    ]
)

RUN_LOG = StructType(
    [
        StructField("run_id", StringType()),
        StructField("step", LongType()),
        StructField("epoch", DoubleType()),
        StructField("metrics", MapType(StringType(), DoubleType())),
    ]
)

CHECKPOINTS = StructType(
    [
        StructField("run_id", StringType()),
        StructField("step", LongType()),
        StructField("path", StringType()),
        StructField("metric", DoubleType()),
    ]
)


def require(df, schema: StructType):
    """``df`` with exactly the columns of ``schema``; raises when one is missing or of another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    for field in schema.fields:
        if field.name not in have:
            raise ValueError(f"missing column {field.name}")
        if have[field.name].simpleString() != field.dataType.simpleString():
            raise ValueError(
                f"column {field.name} is {have[field.name].simpleString()}, not {field.dataType.simpleString()}"
            )
    return df.select(*schema.names)
