"""Readers and writers, over files that Spark writes from the given tables."""

from __future__ import annotations

import os

from pyspark import TaskContext
from pyspark.sql import functions as F

from quillmill.functions.columns import shard_key
from quillmill.operators.combine import shard_grid
from quillmill.operators.splits import take_first
from quillmill.operators.stats import corpus_stats
from quillmill.plans.corpus import blocks_of, split_manifests, with_bibliography
from quillmill.queries.base import (
    BLOCK,
    DOCS,
    SPLIT,
    TOKENS,
    chunks_sql,
    documents,
    query,
    run_log,
    runs_sql,
    split_documents,
    table,
    texts,
    tokenized,
    vocabulary,
)
from quillmill.session import materialize, scratch_path, small_batches
from quillmill.sources import datasets, files, shards
from quillmill.sources.datasets import spread
from quillmill.sources.records import read_csv


def _write_csv(df, path):
    (
        df.write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def _write_files(rows, path, folders, order=()):
    """One file per row of ``text``, in folders by other columns.

    Tasks write local files themselves: Spark starts a process for each file's access rights there. Names have the
    task, the ``order`` columns and a number within task and folder. A task that runs again has the same rows in the
    same order, and so puts the same files in place. Names by Spark have task and number only, so in stores that only
    Spark reads a task gets a range of the order.
    """
    spark = rows.sparkSession
    (text,) = (c for c in rows.columns if c not in (*folders, *order))
    local = files.local_paths(spark, [path])
    if order and local is None:
        rows = rows.repartitionByRange(4 * spark.sparkContext.defaultParallelism, *order)
    ordered = rows.sortWithinPartitions(*folders, *order, text)
    if local is None:  # Spark's tasks put their files in place themselves; the driver would move them one by one
        writer = ordered.select(*folders, text).write.partitionBy(*folders).option("maxRecordsPerFile", 1)
        writer.option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(path)
        return
    (root,) = local
    os.makedirs(root)

    def write(batches):
        task, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        folder, at = None, 0
        for batch in batches:
            for *parts, content in zip(*batch.columns):
                here = "/".join([root, *(f"{name}={part}" for name, part in zip(folders, parts))])
                if here != folder:
                    os.makedirs(here, exist_ok=True)
                    folder, at = here, 0
                name = "-".join([f"part-{task:05d}", *map(str, parts[len(folders) :])]) + f".c{at:03d}.txt"
                with open(f"{here}/.{name}.{attempt}", "wb") as file:
                    file.write(content.as_py() or b"")
                    file.write(b"\n")
                os.replace(file.name, f"{here}/{name}")
                at += 1
        yield from ()

    named = [F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).alias(c) for c in (*folders, *order)]
    plain = ordered.select(*named, F.col(text).cast("binary"))
    with small_batches(spark, 1024):
        plain.mapInArrow(write, "none int").write.format("noop").mode("overwrite").save()


@query(
    "manifest_scan",
    f"""WITH {DOCS} SELECT '/mnt/' || source || '/' || doc_id || '.tex' AS tex, year, year * 100 + month AS month,
        row_number() OVER (ORDER BY doc_id) - 1 AS manifest_pos FROM docs""",
)
def manifest_scan(spark, sf):
    docs = documents(spark, sf)
    tex = F.concat(F.lit("/mnt/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".tex"))
    rows = docs.orderBy("doc_id").select(
        "lang", tex.alias("tex"), shard_key(F.col("year"), F.col("month")).alias("month"), "year"
    )
    return files.read_manifest(spark, _write_csv(rows, scratch_path(spark, "manifest-csv")))


@query(
    "raw_file_read",
    """SELECT (page_id % 4)::INT AS year, (1 + page_id % 12)::INT AS month,
              md5(replace(replace(html, chr(13) || chr(10), chr(10)), chr(13), chr(10)) || chr(10)) AS text_md5
       FROM pages""",
)
def raw_file_read(spark, sf):
    """One file per page in folders by year and month; the manifest is the list of them."""
    root = scratch_path(spark, "raw")
    pages = table(spark, sf, "pages").select(
        (F.col("page_id") % 4).alias("year"), (F.col("page_id") % 12 + 1).alias("month"), "html"
    )
    _write_files(spread(pages, "year", "month"), root, ["year", "month"])
    year, month = (F.regexp_extract("path", f"{part}=([0-9]+)", 1).cast("int") for part in ("year", "month"))
    manifest = files.list_files(spark, root, "*.txt").select(
        F.col("path").alias("tex"), year.alias("year"), month.alias("month")
    )
    read = files.read_documents(spark, materialize(manifest, "manifest"), glob="*.txt")
    return read.select("year", "month", F.md5("text").alias("text_md5"))


@query("bibliography_scan", "SELECT text, count(*) AS n_rows FROM benchmark GROUP BY text")
def bibliography_scan(spark, sf):
    rows = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("bbl"))
    path = _write_csv(rows, scratch_path(spark, "bbl"))
    return files.read_bibliography(spark, path).groupBy("text").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "corpus_csv_percent",
    """SELECT doc_id::VARCHAR AS doc_id, md5(text) AS text_md5 FROM
       (SELECT *, row_number() OVER (ORDER BY doc_id) AS r, count(*) OVER () AS n FROM documents)
       WHERE r <= floor(n * 37.7::DOUBLE / 100)""",
)
def corpus_csv_percent(spark, sf):
    rows = table(spark, sf, "documents").orderBy("doc_id").select("doc_id", "text")
    path = _write_csv(rows, scratch_path(spark, "corpus-csv"))
    return files.read_corpus_csv(spark, path, 37.7).select("doc_id", F.md5("text").alias("text_md5"))


@query("dataset_csv", "SELECT doc_id::VARCHAR AS doc_id, md5(text) AS text_md5 FROM documents")
def dataset_csv(spark, sf):
    path = _write_csv(table(spark, sf, "documents").select("doc_id", "text"), scratch_path(spark, "d") + ".csv")
    return datasets.read_dataset(spark, train=path)["train"].select("doc_id", F.md5("text").alias("text_md5"))


@query("dataset_json", "SELECT conv_id, turn, md5(text) AS text_md5 FROM conversations")
def dataset_json(spark, sf):
    path = scratch_path(spark, "d") + ".json"
    table(spark, sf, "conversations").select("conv_id", "turn", "text").write.json(path)
    read = datasets.read_dataset(spark, train=path, schema="conv_id long, turn long, text string")["train"]
    return read.select("conv_id", "turn", F.md5("text").alias("text_md5"))


@query(
    "dataset_txt",
    """WITH l AS (SELECT unnest(string_split(replace(text, chr(13), chr(10)), chr(10))) AS line FROM documents)
       SELECT line || chr(10) AS text, count(*) AS n_rows FROM l GROUP BY line""",
)
def dataset_txt(spark, sf):
    path = scratch_path(spark, "d") + ".txt"
    table(spark, sf, "documents").select("text").write.text(path)
    lines = datasets.read_dataset(spark, train=path)["train"]
    return lines.groupBy("text").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "table_slice",
    """SELECT doc_id, lang FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS r, count(*) OVER () AS n FROM documents)
       WHERE r <= round_even(n * 10.0::DOUBLE / 100, 0)""",
)
def table_slice(spark, sf):
    out = datasets.read_table_slice(spark, f"{sf.rstrip('/')}/documents.parquet", 0, 10, ["doc_id"])
    return out.select("doc_id", "lang")


@query(
    "named_splits",
    """WITH s AS (SELECT doc_id, lang, CASE WHEN doc_id % 5 < 3 THEN 'train' WHEN doc_id % 5 = 3 THEN 'validation' ELSE 'test' END AS split FROM documents),
       r AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY doc_id) AS r, count(*) OVER (PARTITION BY split) AS n FROM s)
       SELECT split, doc_id, lang FROM r WHERE r <= round_even(n * CASE split WHEN 'train' THEN 1.0::DOUBLE ELSE 10.0::DOUBLE END / 100, 0)""",
)
def named_splits(spark, sf):
    """1 % of train and 10 % of the others, by the files' row counts."""
    root = scratch_path(spark, "splits")
    rest = F.col("doc_id") % 5
    split = F.when(rest < 3, "train").when(rest == 3, "validation").otherwise("test")
    tagged = table(spark, sf, "documents").select("doc_id", "lang", split.alias("split"))
    tagged.repartitionByRange(8, "doc_id").sortWithinPartitions("split", "doc_id").write.partitionBy("split").parquet(root)
    wanted = {"train": "train[:1%]", "test": "test[:10%]", "validation": "validation[:10%]"}
    return datasets.read_splits(spark, root, wanted).select("split", "doc_id", "lang")


@query(
    "shard_round_trip",
    f"""WITH {SPLIT}, {chunks_sql()} SELECT split, year, month, count(*) AS blocks, sum(real + missing)::BIGINT AS slots
        FROM chunks JOIN tagged USING (doc_id) WHERE split = 'train' GROUP BY split, year, month""",
)
def shard_round_trip(spark, sf):
    root = scratch_path(spark, "shards")
    shards.write_shards(blocks_of(split_documents(spark, sf), vocabulary(spark, sf), BLOCK), root)
    read = shards.read_shard(spark, root, split="train")
    return read.groupBy("split", "year", "month").agg(
        F.count(F.lit(1)).alias("blocks"), F.sum(F.size("input_ids")).alias("slots")
    )


@query(
    "shard_sample",
    """SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 40""",
)
def shard_sample(spark, sf):
    path = scratch_path(spark, "sample")
    shards.write_sample(table(spark, sf, "documents").select("doc_id", "lang"), 40, path, ["doc_id"])
    return take_first(spark.read.parquet(path), 40, ["doc_id"])


@query(
    "metrics_json",
    f"""WITH {TOKENS} SELECT lang, count(*) AS papers, sum(len(tok))::BIGINT AS total_tokens
        FROM documents JOIN toks USING (doc_id) GROUP BY lang""",
)
def metrics_json(spark, sf):
    path = scratch_path(spark, "metrics")
    docs = texts(spark, sf).select("doc_id", "lang", "text")
    shards.write_metrics(corpus_stats(tokenized(spark, sf, docs), ["lang"]), path)
    return spark.read.schema("lang string, papers long, total_tokens long").json(path)


@query(
    "run_log_appended",
    f"""WITH {runs_sql()} SELECT run_id, count(*) AS n_records, max(step) AS last_step,
        round(sum(loss), 4) AS loss_sum FROM runs GROUP BY run_id""",
)
def run_log_appended(spark, sf):
    path = scratch_path(spark, "run-log")
    log = run_log(spark, sf)
    records = log.select(
        F.col("run_id").cast("string"),
        "step",
        F.lit(None).cast("double").alias("epoch"),
        F.create_map(F.lit("loss"), "loss").alias("metrics"),
    )
    even = F.col("step") % 2 == 0
    shards.append_run_log(records.where(~even), path)
    shards.append_run_log(records.where(even), path)
    read = spark.read.parquet(path)
    return read.groupBy(F.col("run_id").cast("long").alias("run_id")).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.max("step").alias("last_step"),
        F.round(F.sum(F.col("metrics")["loss"]), 4).alias("loss_sum"),
    )


@query(
    "pretokenize",
    f"""WITH {DOCS},
        ranked AS (SELECT *, doc_id % 3 = 0 AS held, row_number() OVER (PARTITION BY year, month, doc_id % 3 = 0 ORDER BY doc_id) - 1 AS pos,
                          count(*) OVER (PARTITION BY year, month, doc_id % 3 = 0) AS n FROM docs),
        tagged AS (SELECT year, month, text, CASE WHEN NOT held THEN 'train' WHEN pos < floor(n * 0.5::DOUBLE) THEN 'val'
                          WHEN pos < 2 * floor(n * 0.5::DOUBLE) THEN 'test' END AS split FROM ranked),
        kept AS (SELECT split, year, month, text FROM tagged WHERE split IS NOT NULL),
        bib AS (SELECT (item_id % 4)::INT AS year, (1 + (item_id // 4) % 12)::INT AS month, text FROM benchmark),
        every AS (SELECT * FROM kept UNION ALL
                  SELECT split, year, month, bib.text FROM bib JOIN (SELECT DISTINCT split, year, month FROM kept) USING (year, month)),
        sized AS (SELECT split, year, month, len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')) AS n FROM every),
        made AS (SELECT split, year, month, sum(ceil(n / {BLOCK}))::BIGINT AS blocks,
                        sum(n // {BLOCK} + CASE WHEN n % {BLOCK} > 0 AND 2 * (n % {BLOCK}) >= {BLOCK} THEN 1 ELSE 0 END)::BIGINT AS num_chunks
                 FROM sized WHERE n > 0 GROUP BY split, year, month),
        grid AS (SELECT split, year, month FROM (SELECT unnest(['train', 'val', 'test']) AS split),
                 (SELECT unnest(range(4))::INT AS year), (SELECT unnest(range(1, 14))::INT AS month))
        SELECT split, year, year * 100 + month AS month, coalesce(blocks, 0) AS blocks, coalesce(num_chunks, 0) AS num_chunks,
               blocks IS NOT NULL AS present FROM grid LEFT JOIN made USING (split, year, month)""",
)
def pretokenize(spark, sf):
    """The whole way: manifests and files, heads by shard, bibliography, tokens, blocks, shards, presence report.

    Every document is a file of its own, every third one is in the test manifest. The grid has a 13th month,
    which no shard fills.
    """
    root = scratch_path(spark, "papers")
    docs = documents(spark, sf).select("doc_id", "year", shard_key(F.col("year"), F.col("month")).alias("month"), "text")
    docs = docs.withColumn("held", (F.col("doc_id") % 3 == 0).cast("int"))
    # files' names lead through a folder by doc_id: they have it, or else the number of the task that has a range of them
    _write_files(docs, root, ["year", "month", "held"], ["doc_id"])
    year, month, held = (F.regexp_extract("path", f"/{part}=([0-9]+)/", 1).cast("long").alias(part) for part in ("year", "month", "held"))
    task, at = (F.regexp_extract("path", r"/part-([0-9]+)-[^/]*\.c([0-9]+)\.txt$", i).cast("long").alias(n) for i, n in ((1, "task"), (2, "at")))
    named = F.regexp_extract("path", r"/part-[0-9]+-([0-9]+)\.c[0-9]+\.txt$", 1).try_cast("long").alias("named")
    listed = files.list_files(spark, root, "*.txt").select(F.col("path").alias("tex"), year, month, held, named, task, at)
    listed = materialize(listed, "papers-listed")
    train, test = (
        files.read_manifest(spark, _write_csv(listed.where(F.col("held") == part).orderBy("named", "task", "at", "tex"), scratch_path(spark, "manifest-csv")))
        for part in (0, 1)
    )
    manifest = materialize(split_manifests(train, test).select("split", "year", "month", "tex"), "split-manifest")
    papers = files.read_documents(spark, manifest, root=root, glob="*.txt")
    place = (F.col("item_id") % 4).alias("year"), (F.floor(F.col("item_id") / 4) % 12 + 1 + F.col("item_id") % 4 * 100).alias("month")
    bibliography = _write_csv(table(spark, sf, "benchmark").select(*place, F.col("text").alias("bbl")), scratch_path(spark, "bbl"))
    read = read_csv(spark, bibliography, "year int, month int, text string").withColumn("tex", F.lit(None).cast("string"))
    both = with_bibliography(papers, {split: read for split in ("train", "val", "test")})
    shard_root = scratch_path(spark, "shards")
    shards.write_shards(blocks_of(both, vocabulary(spark, sf), BLOCK, keep=["split", "year", "month", "tex"]), shard_root)
    counted = F.sum(F.when(F.col("num_chunks") != -1, F.col("num_chunks")))
    made = shards.read_shard(spark, shard_root).groupBy("split", "year", "month").agg(F.count(F.lit(1)).alias("blocks"), counted.alias("num_chunks"))
    grid = shard_grid(spark, 4, 13).withColumn("month", shard_key(F.col("year"), F.col("month")))
    grid = grid.select(F.explode(F.array(*[F.lit(s) for s in ("train", "val", "test")])).alias("split"), "year", "month")
    report = grid.join(made, ["split", "year", "month"], "left")
    zero = F.lit(0)
    return report.select(
        "split", "year", "month", F.coalesce("blocks", zero).alias("blocks"), F.coalesce("num_chunks", zero).alias("num_chunks"),
        F.col("blocks").isNotNull().alias("present"),
    )
