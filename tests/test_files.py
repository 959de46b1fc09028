"""Readers and writers on small files."""

import json

import pytest
from pyspark.sql import functions as F

from quillmill import session
from quillmill.operators import splits
from quillmill.sources import datasets, files, shards


def write(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def test_manifest(spark, tmp_path):
    body = "id,tex,year,month\n" + "".join(f"{i},/x/{i}.tex,{i % 2},{i % 2 * 100 + 1}\n" for i in range(50))
    got = files.read_manifest(spark, write(tmp_path / "train.csv", body)).orderBy("manifest_pos").collect()
    assert [(r.tex, r.year, r.month, r.manifest_pos) for r in got] == [
        (f"/x/{i}.tex", i % 2, i % 2 * 100 + 1, i) for i in range(50)
    ]


@pytest.fixture()
def tex(tmp_path):
    """Files in folders named by their first letter."""
    texts = {
        "utf8.tex": "café 中".encode(),
        "latin.tex": b"caf\xe9",
        "crlf.tex": b"a\r\nb\rc\n",
        "empty.tex": b"",
        "unlisted.tex": b"never read",
    }
    for name, data in texts.items():
        write(tmp_path / "tex" / name[0] / name, data)
    return tmp_path / "tex"


EXPECTED = {"utf8": "café 中", "latin": "café", "crlf": "a\nb\nc\n", "empty": ""}


@pytest.mark.parametrize("max_listed", [10_000, 1])
def test_documents(spark, tex, max_listed):
    manifest = spark.createDataFrame([(f"{tex}/{n[0]}/{n}.tex", 0) for n in EXPECTED], "tex string, year int")
    got = files.read_documents(spark, manifest, root=str(tex), max_listed=max_listed).collect()
    assert {r.tex.split("/")[-1][:-4]: r.text for r in got} == EXPECTED
    assert all(r.year == 0 for r in got)


@pytest.mark.parametrize("max_listed", [10_000, 2])
def test_missing_document_raises(spark, tex, max_listed):
    names = ["lost", "utf8", "latin", "empty"]
    manifest = spark.createDataFrame([(f"{tex}/{n[0]}/{n}.tex",) for n in names], "tex string")
    with pytest.raises(Exception, match="lost.tex"):
        files.read_documents(spark, manifest, root=str(tex), max_listed=max(max_listed, 2)).collect()
    with pytest.raises(ValueError):
        files.read_documents(spark, manifest.union(manifest.select(F.lit("x"))), max_listed=1)


def test_unread_files_are_never_empty_texts(spark, tmp_path):
    """Names that a listing hides, other suffixes and files outside the root raise."""
    for name in ("in/_b.tex", "in/.c.tex", "in/d.ltx", "in/e.tex", "out/f.tex"):
        write(tmp_path / name, b"text")
    for name, options in {
        "in/_b.tex": {},
        "in/.c.tex": {},
        "in/d.ltx": {"glob": "*.tex"},
        "out/f.tex": {"root": str(tmp_path / "in"), "max_listed": 0},
    }.items():
        manifest = spark.createDataFrame([(f"{tmp_path}/{name}",), (f"{tmp_path}/in/e.tex",)], "tex string")
        with pytest.raises(FileNotFoundError, match=name.split("/")[-1]):
            files.read_documents(spark, manifest, **options).collect()


def test_many_empty_files(spark, tmp_path):
    for i in range(30):
        write(tmp_path / "many" / f"{i} %.tex", b"" if i else b"full")
    manifest = spark.createDataFrame([(f"{tmp_path}/many/{i} %.tex",) for i in range(30)], "tex string")
    got = files.read_documents(spark, manifest, max_listed=2).collect()
    assert sorted(r.text for r in got) == [""] * 29 + ["full"]


def test_bibliography(spark, tmp_path):
    body = 'key,bbl\n1,"two\nlines, ""quoted"""\n2,plain\n'
    write(tmp_path / "TRAIN_BBL" / "bbl_split_train_0001.csv", body)
    write(tmp_path / "TRAIN_BBL" / "bbl_split_train_1211.csv", "key,bbl\n3,other\n")
    one = files.read_bibliography(spark, str(tmp_path / "TRAIN_BBL" / "bbl_split_train_0001.csv"))
    assert sorted(r.text for r in one.collect()) == ["plain", 'two\nlines, "quoted"']
    every = files.read_bibliography_shards(spark, str(tmp_path / "TRAIN_BBL" / "*.csv"))
    assert {(r.text, r.year, r.month) for r in every.collect()} == {
        ("plain", 0, 1), ('two\nlines, "quoted"', 0, 1), ("other", 12, 1211),
    }


def test_corpus_csv_counts_records(spark, tmp_path):
    body = "a,text\n" + "".join(f'{i},"line\n{i}"\n' for i in range(9)) + ",no a\n"
    path = write(tmp_path / "c.csv", body)
    assert files.read_corpus_csv(spark, path).count() == 9
    half = files.read_corpus_csv(spark, path, 50).collect()
    assert sorted(int(r.a) for r in half) == [0, 1, 2, 3, 4]
    assert files.read_corpus_csv(spark, path, 3).count() == 0


def test_datasets(spark, tmp_path):
    txt = write(tmp_path / "t.txt", "one\n\nthree\n")
    assert [r.text for r in datasets.read_dataset(spark, train=txt)["train"].collect()] == ["one\n", "\n", "three\n"]
    bare = datasets.read_dataset(spark, train=txt, keep_linebreaks=False)["train"]
    assert [r.text for r in bare.collect()] == ["one", "", "three"]
    js = write(tmp_path / "v.json", json.dumps({"text": "x", "n": 1}) + "\n")
    both = datasets.read_dataset(spark, validation=js)
    assert list(both) == ["validation"] and both["validation"].first().text == "x"
    for bad in ({}, {"train": "a.parquet"}, {"train": txt, "validation": js}):
        with pytest.raises(ValueError):
            datasets.read_dataset(spark, **bad)


def blocks(spark, split, year, month, n):
    return spark.range(n).select(
        F.lit(split).alias("split"), F.lit(year).alias("year"), F.lit(month).alias("month"), "id"
    )


def test_shards(spark, tmp_path):
    root = str(tmp_path / "shards")
    shards.write_shards(blocks(spark, "train", 0, 1, 5).union(blocks(spark, "val", 0, 1, 2)), root)
    shards.write_shards(blocks(spark, "train", 0, 2, 3), root)
    shards.write_shards(blocks(spark, "val", 0, 1, 4), root)  # replaces one shard only
    assert shards.read_shard(spark, root).count() == 12
    assert shards.read_shard(spark, root, "val", 0, 1).count() == 4
    present = {tuple(r) for r in shards.present_shards(spark, root).collect()}
    assert present == {("train", 0, 1), ("train", 0, 2), ("val", 0, 1)}


def test_ranks_sample_metrics_log(spark, tmp_path):
    ranked = spark.range(12).withColumn("rank", (F.col("id") % 3).cast("int"))
    shards.write_ranks(ranked, str(tmp_path / "ranks"))
    assert spark.read.parquet(str(tmp_path / "ranks")).where("rank = 1").count() == 4
    shards.write_sample(ranked, 5, str(tmp_path / "sample"), ["id"])
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "sample")).collect()) == [0, 1, 2, 3, 4]
    shards.write_metrics(spark.range(1).select(F.lit(1.5).alias("perplexity")), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).first().perplexity == 1.5
    record = spark.range(1).select(F.lit("r").alias("run_id"), F.lit(1).cast("long").alias("step"))
    for _ in range(2):
        shards.append_run_log(record, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_table_slice(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(200).write.parquet(path)
    out = datasets.read_table_slice(spark, path, 0, 1, ["id"])
    assert sorted(r.id for r in out.collect()) == [0, 1]
    spark.read.parquet(path).createOrReplaceTempView("numbers")
    assert datasets.read_table_slice(spark, "numbers", 99, 100, ["id"]).count() == 2


def test_row_percent(spark):
    df = spark.range(100)
    assert splits.row_percent(df, None, ["id"]).count() == 100
    assert splits.row_percent(df, 29, ["id"]).count() == 29


def test_named_slices_skip_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(0, 1000, 1, 10).withColumn("split", F.when(F.col("id") < 900, "train").otherwise("test"))
    rows.write.partitionBy("split").parquet(path)

    def ids(split):
        return sorted(r.id for r in datasets.read_split(spark, path, split).collect())

    assert ids("train") == list(range(900)) and ids("test") == list(range(900, 1000))
    assert ids("train[:1%]") == list(range(9)) and ids("train[99%:]") == list(range(891, 900))
    assert ids("train[10%:50%]") == list(range(90, 450)) and ids("test[25%:25%]") == []
    assert ids("train[:100%]") == list(range(900)) and ids("train[100%:]") == [] and ids("none[:10%]") == []
    for bad in ("train[5]", "train[:x%]", "[:1%]", "train[:1%", ""):
        with pytest.raises(ValueError):
            datasets.read_split(spark, path, bad)
    few = datasets.read_split(spark, path, "train[:1%]")
    few.collect()
    plan = few._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 1


@pytest.fixture()
def manifests(monkeypatch):
    """The manifests that queries read files by."""
    seen, read = [], files.read_documents

    def spied(spark, manifest, **options):
        seen.append(manifest)
        return read(spark, manifest, **options)

    monkeypatch.setattr(files, "read_documents", spied)
    return seen


def test_papers_are_written_to_one_folder_a_shard(spark, tmp_path, manifests):
    from quillmill.queries import QUERIES

    n = 600
    docs = spark.createDataFrame([(i, f"w{i}") for i in range(n)], "doc_id long, text string")
    docs.select("*", F.lit("en").alias("lang"), F.lit("s").alias("source")).orderBy(F.rand(5)).repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, "bib")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    report = QUERIES["pretokenize"](spark, str(tmp_path)).collect()
    assert sum(r.blocks for r in report if r.split == "train") == n - n // 3 + sum(r.split == "train" and r.year == 0 and r.month == 1 and r.present for r in report)
    (manifest,) = manifests
    rows = manifest.collect()
    assert len({r.tex.rsplit("/", 1)[0] for r in rows}) <= 4 * 12 * 2
    assert len({r.tex for r in rows}) == len(rows)  # a file for each
    shards = {}
    for r in rows:
        with open(r.tex) as f:
            shards.setdefault((r.year, r.month), {}).setdefault(r.split, []).append(int(f.read().strip()[1:]))
    for (year, month), split in shards.items():
        held = [i for i in range(n) if i % 3 == 0 and (i % 4, i // 4 % 12 + 1 + i % 4 * 100) == (year, month)]
        half = len(held) // 2
        assert sorted(split.get("val", [])) == held[:half] and sorted(split.get("test", [])) == held[half : 2 * half]


def test_raw_files_are_listed_once(spark, tmp_path, manifests):
    from quillmill.queries import QUERIES

    pages = spark.createDataFrame([(i, f"<p>{i}</p>") for i in range(30)], "page_id long, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    assert QUERIES["raw_file_read"](spark, str(tmp_path)).count() == 30
    assert "binaryFile" not in manifests[0]._jdf.queryExecution().executedPlan().toString()


def texts_by_name(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in root.rglob("*") if p.is_file()}


def test_tasks_write_a_file_a_row(spark, tmp_path):
    """Nothing else is written, and rows that come in another order give the same files."""
    from quillmill.queries.sources import _write_files

    rows = [(i % 2, i // 4, f"text {i % 7}\r\n é" if i % 5 else None) for i in range(40)]
    for name, order in (("a", rows), ("b", rows[::-1])):
        df = spark.createDataFrame(order, "part int, id int, text string").repartition(3, "part", "id")
        _write_files(df, f"{tmp_path}/{name}", ["part"], ["id"])
    written = texts_by_name(tmp_path / "a")
    assert sorted(written.values()) == sorted(f"{text or ''}\n".encode() for _, _, text in rows)
    assert written == texts_by_name(tmp_path / "b") and {name.split("/")[0] for name in written} == {"part=0", "part=1"}
    numbered = [(int(n.split("-")[1]), int(n.split(".c")[1].split(".")[0])) for n in written if n.startswith("part=1")]
    assert len(set(numbered)) == len(numbered) == 20 and min(at for _, at in numbered) == 0


def test_no_rows_make_an_empty_folder(spark, tmp_path):
    from quillmill.queries.sources import _write_files

    _write_files(spark.createDataFrame([], "part int, text string"), f"file://{tmp_path}/none", ["part"])
    assert files.list_files(spark, f"{tmp_path}/none", "*.txt").collect() == []


@pytest.fixture()
def store(spark, tmp_path):
    """A path that only Spark reads, to the folder ``tmp_path``/in."""
    name = f"s{tmp_path.name}".replace("_", "")
    (tmp_path / "in").mkdir()
    spark.sparkContext._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{name}.link./in", f"file://{tmp_path}/in")
    return f"viewfs://{name}/in"


def test_files_of_a_store(spark, tmp_path, store):
    from quillmill.queries.sources import _write_files

    df = spark.createDataFrame([(i % 2, i, f"text {i}") for i in range(12)], "part int, id int, text string")
    _write_files(df, f"{store}/files", ["part"], ["id"])
    (tmp_path / "in/files/part=0/empty.txt").touch()
    listed = files.list_files(spark, f"{store}/files", "*.txt")
    assert listed.count() == 12 and all(r.path.startswith(store) for r in listed.collect())
    manifest = listed.select(F.col("path").alias("tex")).union(spark.createDataFrame([(f"{store}/files/part=0/empty.txt",)], "tex string"))
    for limits in ({}, {"max_listed": 1, "root": f"{store}/files"}):
        got = files.read_documents(spark, manifest, **limits)
        assert sorted(r.text for r in got.collect()) == sorted(["", *(f"text {i}\n" for i in range(12))])
    with pytest.raises(FileNotFoundError, match="lost"):
        files.read_documents(spark, manifest.union(manifest.select(F.lit(f"{store}/files/part=0/lost.txt"))))


def test_papers_of_a_store_are_split_alike(spark, tmp_path, store, manifests, monkeypatch):
    """The shared folder is in a store, whose files Spark writes under its own names."""
    from quillmill.queries import QUERIES

    docs = spark.createDataFrame([(i, f"w{i} w", "en", "s") for i in range(200)], "doc_id long, text string, lang string, source string")
    docs.orderBy(F.rand(5)).repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, "bib")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    splits = []
    for shared in (f"file://{tmp_path}/shared", f"{store}/shared"):
        monkeypatch.setattr(session, "shared_dir", lambda spark, shared=shared: shared)
        QUERIES["pretokenize"](spark, str(tmp_path)).collect()
        read = files.read_documents(spark, manifests.pop(), root=shared, glob="*.txt")
        splits.append(sorted((r.split, r.year, r.month, r.text) for r in read.collect()))
        manifests.clear()
    assert splits[0] == splits[1] and {s[0] for s in splits[0]} == {"train", "val", "test"}


@pytest.fixture()
def tree(tmp_path):
    """Files on all levels, some of them hidden, empty or linked."""
    for i, name in enumerate(
        ["a.tex", "_h.tex", ".h.tex", "x._COPYING_", "k=1/b.tex", "k=1/_l=2/c.tex", "_k/d.tex", ".k/e.tex", "p q/%41 é.tex", "p q/+&.tex",
         "1/2/3/4/5/6/f.tex", "1/2/3/4/5/_6/g.tex", "1/2/3/_h.tex", "1/2/g.txt", "1/2/3/h.tex", "1/i.tex"]
    ):
        write(tmp_path / "tree" / name, "x" * (i + 1))
    write(tmp_path / "tree/1/2/3/4/empty.tex", "")
    (tmp_path / "tree/1/hollow").mkdir()
    (tmp_path / "tree/1/nowhere.tex").symlink_to(tmp_path / "gone")
    write(tmp_path / "elsewhere/linked/j.tex", "linked")
    (tmp_path / "tree/link").symlink_to(tmp_path / "elsewhere")
    return tmp_path / "tree"


@pytest.mark.parametrize("glob", ["*", "?.t[ef]x", "[!a-c].tex", "[^f].t?x", "{a,b,g}.{tex,txt}", "%41*", "\\+&.tex", "a*e*x"])
def test_tasks_list_what_spark_lists(spark, tree, glob):
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    expected = reader.load(str(tree)).select(files.plain_path(F.col("path")), "length")
    listed = files.list_files(spark, str(tree), glob)
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, expected.collect()))
    assert "binaryFile" not in listed._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("options", [{}, {"max_listed": 1}])
def test_tasks_open_files_without_moving_them(spark, tree, monkeypatch, options):
    """No names go through the driver, no contents through an exchange or a join; large ones are handed on in pieces."""
    monkeypatch.setattr(files, "BATCH_BYTES", 8)
    listed = files.list_files(spark, str(tree), "*.tex").select(F.concat(F.lit("file:"), "path").alias("tex"), F.array("length").alias("n"))
    seen, missing = [], files.missing_files
    monkeypatch.setattr(files, "missing_files", lambda *tables: seen.append(missing(*tables)) or seen[-1])
    lost = str(tree / "1/2/3/4/empty.tex")
    manifest = listed.union(listed.limit(3)).union(spark.createDataFrame([(lost, [0])], "tex string, n array<bigint>"))
    read = files.read_documents(spark, manifest, root=f"file://{tree}", **options)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "Join" not in plan
    assert "Broadcast" not in seen[-1]._jdf.queryExecution().executedPlan().toString()
    rows = read.collect()
    assert len(rows) == listed.count() + 4
    for r in rows:
        with open(r.tex.removeprefix("file:"), "rb") as f:
            assert r.text == f.read().decode() and r.n == [len(r.text)]
    for bad in (f"{tree}//a.tex", f"{tree}/1/hollow", f"{tree}/no/a.tex", None):
        with pytest.raises(FileNotFoundError):
            files.read_documents(spark, spark.createDataFrame([(bad,), (f"{tree}/a.tex",)], "tex string"), root=str(tree), **options)
