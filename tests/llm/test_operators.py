"""The corpus operators against plain versions, on a small table with every odd case."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n):
    words = [rng.choice("ka lo mi nu pe ra so ti vu we".split()) + rng.choice("ban cor den fol gim".split()) for _ in range(n)]
    return " ".join(words).capitalize() + "."


@pytest.fixture(scope="module")
def rows():
    """Nulls, empty and very long texts, copies, near copies, repeated rows and shared passages."""
    rng = random.Random(5)
    texts = ["\n".join(sentence(rng, rng.randint(6, 30)) for _ in range(rng.randint(2, 12))) for _ in range(60)]
    base = texts[0] + "\n" + texts[1] + "\n" + texts[2]
    texts += [base] * 5  # copies
    for i in range(6):  # near copies
        words = base.split(" ")
        words[40 + 3 * i] = "other" + str(i)
        texts.append(" ".join(words))
    passage = sentence(rng, 55)
    texts += ["\n".join([sentence(rng, 12), passage, sentence(rng, 14)]) for _ in range(12)]
    texts += ["", " \n\t ", "one", "two words", "x" * 200_000, "ab cd\n" * 30_000, "a@b.co 10.0.0.1 +1 (988) 555-2485", "é中😀 <|endoftext|> it's  we'll"]
    out = [(i, t, rng.choice(["en", "de", None]), "hot" if i % 3 == 0 else f"s{i % 5}", len(t)) for i, t in enumerate(texts)]
    out += [(len(out), None, None, None, None), out[3], out[3], out[-1], (None, texts[5], "en", "hot", 1)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(docs):
    """Extra columns with names that operators use themselves."""
    for name in ("id", "node", "shard", "slot", "record", "score", "template", "size", "copy_no", "length", "text_hash", "first", "kept"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs


def ordered(values):
    return sorted(values, key=lambda r: tuple((v is not None, str(v)) for v in r))


# ---- sharding


def test_sharding_follows_its_law(spark, docs, rows):
    from quillmill.llm.sharding import shard_texts

    for shards in (1, 4, 24):
        got = shard_texts(clashing(docs), shards).collect()
        assert len(got) == len(rows)
        expected = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
        assert Counter((r.id, r.size, r.text_crc32) for r in got) == expected
        slots = defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        # by the definition: the middle of a group (or of a heavy group's row) on the line of all bytes
        line = sorted(got, key=lambda r: (r.text_hash, r.id is not None, r.id, r.size))
        total = sum(r.size for r in got)
        weight = Counter()
        for r in got:
            weight[r.text_hash] += r.size
        at, first, expected_shard = 0, {}, []
        for r in line:
            first.setdefault(r.text_hash, at)
            at += r.size
            w = weight[r.text_hash]
            middle = 2 * first[r.text_hash] + w if w * 16 * shards <= total else 2 * at - r.size
            expected_shard.append(min(shards - 1, middle * shards // (2 * total)))
        assert [r.shard for r in line] == expected_shard


def test_sharding_keeps_equal_texts_together_and_bytes_even(spark):
    from quillmill.llm.sharding import shard_texts

    rng = random.Random(1)
    data = [(i, f"text {rng.randint(0, 900)} " * rng.randint(1, 30)) for i in range(3000)]
    data += [(10_000 + i, "the hot text " * 12) for i in range(1500)]
    got = shard_texts(spark.createDataFrame(data, "doc_id long, text string"), 8).collect()
    loads, shards_of, weights = Counter(), defaultdict(set), Counter()
    for r in got:
        loads[r.shard] += r.size
        shards_of[r.text_hash].add(r.shard)
        weights[r.text_hash] += r.size
    mean = sum(loads.values()) / 8
    assert max(loads.values()) < 1.07 * mean and min(loads.values()) > 0.93 * mean
    assert all(len(s) == 1 for t, s in shards_of.items() if weights[t] * 16 <= mean)


def test_sharding_of_nothing_and_files(spark, docs, empty, rows, tmp_path):
    from quillmill.llm.sharding import shard_texts, write_shards

    assert shard_texts(empty, 24).count() == 0
    write_shards(docs, 4, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(rows)
    with pytest.raises(ValueError):
        shard_texts(docs, 0)


# ---- tokens


@pytest.fixture(scope="module")
def library():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_tokens_equal_the_library(docs, empty, rows, library):
    from quillmill.llm.tokens import TOKENIZER, encode_documents, token_digests

    for r in encode_documents(clashing(docs.select("doc_id", "text")).drop("id"), TOKENIZER).collect():
        text = next((x[1] or "" for x in rows if x[0] == r.id))
        assert r.ids == library.encode(text, add_special_tokens=False).ids
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)
    got = {r.id: r for r in token_digests(docs, TOKENIZER).collect()}
    ids = library.encode(rows[7][1], add_special_tokens=False).ids
    assert got[7].ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
    assert encode_documents(empty, TOKENIZER).count() == 0


def test_chunks_of_any_shape(library):
    import public_tokenizers

    from quillmill.llm.tokens import ChunkedBpe

    coder = ChunkedBpe(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    pieces = ["a", "b", " ", "  ", "\n", "'s", "'re", "é", "1", "22", "!", "\xa0", "　", "中", "😀", "\x1c", "\t", "<|endoftext|>", "<|endof", "the and"]
    for n in (0, 1, 300, 3000):
        for _ in range(25):
            text = "".join(rng.choices(pieces, k=n))
            ids = coder.encode(text).tolist()
            assert ids == library.encode(text, add_special_tokens=False).ids
            assert coder.decode(ids) == text
    shared = " ".join(f"word{rng.randint(0, 9999)}" for _ in range(4000))
    coder.encode(shared)
    before = coder.reused
    coder.encode("A new head. " + shared)
    assert coder.reused > before + 10


# ---- classifier


def test_classifier_learns_only_what_it_may(spark):
    from quillmill.llm.classifier import fit, held_out, is_held_out, score

    rng = random.Random(2)
    data, labels = [], []
    for i in range(900):
        good = i % 3 > 0
        text = sentence(rng, 40) if good else sentence(rng, 40).upper().replace(" ", "!! ")
        data.append((i, text))
        labels.append((i, int(good)))
    docs = spark.createDataFrame([*data, (1000, ""), (1001, None), (1002, "x" * 100_000)], "id long, text string")
    table = spark.createDataFrame([*labels, (None, 1), (5, None)], "id long, label int")
    voters = fit(docs, table.where(~held_out("id")))
    got = {r.id: r.score for r in score(docs, voters).collect()}
    assert len(got) == 903 and all(0.0 <= s <= 1.0 for s in got.values())
    test = [i for i, _ in data if is_held_out(i)]
    assert sum((got[i] >= 0.5) == bool(labels[i][1]) for i in test) >= 0.98 * len(test)
    assert got[1000] == got[1001] == pytest.approx(voters.prior)
    # flipped labels of held-out rows change nothing
    flipped = [(i, 1 - y if is_held_out(i) else y) for i, y in labels]
    again = fit(docs, spark.createDataFrame(flipped, "id long, label int").where(~held_out("id")))
    assert {r.id: r.score for r in score(docs, again).collect()} == got


def test_classifier_ignores_row_order(spark):
    from quillmill.llm.classifier import fit, score

    rng = random.Random(13)
    data = [(i, sentence(rng, 3), rng.randint(0, 1)) for i in range(120)]
    scores = []
    for parts, seed in ((1, 0), (5, 1)):
        random.Random(seed).shuffle(data)
        table = spark.createDataFrame(data, "id long, text string, label int").repartition(parts)
        voters = fit(table.select("id", "text"), table.select("id", "label"))
        scores.append({r.id: r.score for r in score(table.select("id", "text"), voters).collect()})
    assert scores[0] == pytest.approx(scores[1], abs=1e-5)  # blocks of other sizes round differently


def test_classifier_without_labels(spark, docs):
    from quillmill.llm.classifier import fit, score

    rows = docs.select(F.col("doc_id").alias("id"), "text")
    voters = fit(rows, spark.createDataFrame([], "id long, label int"))
    assert {r.score for r in score(rows, voters).collect()} == {0.5}


def test_scores_are_exact_neighbour_votes():
    import numpy as np

    from quillmill.llm.classifier import DIMS, NEIGHBOURS, Voters, text_counts

    rng = random.Random(4)
    counts = np.array([text_counts(sentence(rng, 30)) for _ in range(200)])
    labels = np.array([rng.randint(0, 1) for _ in range(200)], float)
    voters = Voters(counts, labels)
    assert voters.vectors.shape == (200, DIMS)
    near = voters.vectors @ voters.vectors.T
    for i, s in enumerate(voters.scores(counts)[:20]):
        best = np.argsort(-near[i])[:NEIGHBOURS]
        w = np.maximum(near[i][best], 0)
        assert s == pytest.approx((w * labels[best]).sum() / w.sum(), abs=1e-3)


# ---- fingerprints


def plain_fingerprint(text):
    """Order MinHash by its definition, with the same hashes."""
    from quillmill.llm.fingerprints import BINS, LONG, PIECE

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def of_longs(*values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest((v & (1 << 64) - 1).to_bytes(8, "little"), seed)
        return signed(seed)

    def of_texts(*values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest(v.encode(), seed)
        return signed(seed)

    pieces = []
    for w in (text or "").encode().split():
        w = w.decode()
        pieces += [w] if len(w.encode()) <= LONG else [w[i : i + PIECE] for i in range(0, len(w), PIECE)]
    seen, bins = Counter(), defaultdict(list)
    for i in range(len(pieces)):
        mer = of_texts(*pieces[i : i + 2]) >> 24
        seed = xxhash.xxh64_intdigest((mer & (1 << 64) - 1).to_bytes(8, "little"), 42)
        pair = signed(xxhash.xxh64_intdigest((seen[mer]).to_bytes(4, "little"), seed)) >> 24
        seen[mer] += 1
        bins[(pair & (1 << 40) - 1) >> (40 - int(math.log2(BINS)))].append((pair, i))
    out = {}
    for b, found in bins.items():
        least = sorted(sorted(found)[:2], key=lambda x: x[1])
        out[b] = (of_longs(*[p for p, _ in least]) & (1 << 64) - 1) >> 32
    return out


def test_fingerprints_by_definition(spark, docs, rows, empty):
    from quillmill.llm.fingerprints import edited_fingerprints

    got = edited_fingerprints(clashing(docs)).collect()
    assert len(got) == len(rows) and edited_fingerprints(empty).count() == 0
    line = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0], r[1]))
    expected = []
    for i, (ident, text) in enumerate(line):
        after = line[(i + 1) % len(line)][1]
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        a, b, c = plain_fingerprint(text), plain_fingerprint(edited), plain_fingerprint(after)

        def like(x, y):
            return sum(x.get(k) == y[k] for k in y) / len(x.keys() | y.keys()) if x or y else 1.0

        def spelt(x):
            return "".join(f"{(k << 32) + x[k]:010X}" for k in sorted(x))

        expected.append((ident, len(text), hashlib.sha256(edited.encode()).hexdigest(), spelt(a), spelt(b), round(like(a, b), 9), round(like(a, c), 9)))
    assert ordered((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got) == ordered(expected)


def test_fingerprints_have_no_python(docs):
    from quillmill.llm.fingerprints import edited_fingerprints

    plan = edited_fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ---- personal data

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_forms(text):
    def valid(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(p) <= 255 for p in value.split("."))
        if kind == "card":
            total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
            return 13 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return [f"{k}:{m.start()}:{m.end()}" for k, p in FORMS.items() for m in re.finditer(p, text) if valid(k, m.group())]


def test_personal_data_forms(spark, docs, rows, empty):
    from quillmill.llm.pii import FORMS as KINDS
    from quillmill.llm.pii import find_personal_data, span_list

    rng = random.Random(9)
    odd = ["".join(rng.choices(["a", "b.", "@", ".", "-", "_", "7", "255.", "1.2.3.4", "+1 ", "(", "4111 1111 1111 1111", " ", "é😀"], k=rng.randint(1, 40))) for _ in range(400)]
    odd += ["a@b.c_x@d.e", "1.2.3.4.5.6.7.8", "0001.2.3.4 256.1.1.1", "a@b..c", "+1+22 33 44 55 66", "1" * 50_000, "a." * 20_000 + "@x.y"]
    table = spark.createDataFrame([*rows, *[(1000 + i, t, "en", "o", 0) for i, t in enumerate(odd)]], SCHEMA)
    found = find_personal_data(clashing(table)).select("id", span_list(list(KINDS)).alias("spans")).collect()
    texts = defaultdict(list)
    for ident, text, *_ in table.select("doc_id", "text").collect():
        texts[ident].append(",".join(plain_forms(text or "")))
    got = defaultdict(list)
    for r in found:
        got[r.id].append(r.spans)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in texts.items()}
    assert find_personal_data(empty).count() == 0


def test_contexts_discover_identifiers(spark):
    from quillmill.llm.pii import find_personal_data

    rng = random.Random(8)
    data = [(i, f"{sentence(rng, 9)} reach me at: 10.{rng.randint(0, 255)}.{i % 256}.7 today {sentence(rng, 5)}") for i in range(60)]
    data += [(100 + i, f"{sentence(rng, 9)} reach me at: QX-{4_000_000 + 7919 * i} today {sentence(rng, 5)}") for i in range(5)]
    data += [(200 + i, f"{sentence(rng, 9)} release of model TZ-{5_000_000 + i} {sentence(rng, 5)}") for i in range(20)]
    got = {r.id: [c.v for c in r.context] for r in find_personal_data(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert all(got[100 + i] == [f"QX-{4_000_000 + 7919 * i}"] for i in range(5))
    assert not any(v for k, v in got.items() if not 100 <= k < 105)


# ---- mixing


def test_mixing_hits_its_targets(spark, docs, empty):
    from quillmill.llm.mixing import repetition_rates, replicate

    big = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("ten chars.").alias("text"), F.when(F.col("id") % 10 < 7, "a").when(F.col("id") % 10 < 9, "b").otherwise("c").alias("source")
    )
    rates = repetition_rates(big, {"a": 1, "b": 1, "c": 2})
    assert {r.source: round(r.rate, 6) for r in rates.collect()} == {"a": round(0.25 / 0.7, 6), "b": 1.25, "c": 5.0}
    mixed = replicate(big, rates, 3)
    share = {r.source: r["count"] / 20_000 for r in mixed.groupBy("source").count().collect()}
    assert share == pytest.approx({"a": 0.25, "b": 0.25, "c": 0.5}, rel=0.05)
    per = mixed.where("source = 'b'").groupBy("doc_id").agg(F.count("*").alias("n"), F.max("copy").alias("last"))
    assert per.where("n != last + 1").count() == 0
    none = 4000 - per.count()
    assert none == pytest.approx(4000 * math.exp(-1.25), rel=0.1)
    assert ordered(mixed.collect()) == ordered(replicate(big, rates, 3).collect())
    assert replicate(empty, repetition_rates(empty, 0.5), 3).count() == 0


def test_mixing_keeps_columns_and_odd_rows(docs):
    from quillmill.llm.mixing import repetition_rates, replicate

    odd = clashing(docs)
    got = replicate(odd, repetition_rates(odd, {"hot": 1.0}), 3, copy_col=None)
    assert got.columns == odd.columns and {r.source for r in got.collect()} == {"hot"}
    every = replicate(docs, repetition_rates(docs, 1.0), 3)
    assert every.where("source is null").count() >= 0 and every.count() > 0
    with pytest.raises(ValueError):
        repetition_rates(docs, {})


# ---- lines


def test_line_templates(docs, rows, empty):
    from quillmill.llm.lines import drop_boilerplate, templates

    got = drop_boilerplate(clashing(docs)).collect()
    assert len(got) == len(rows) and drop_boilerplate(empty).count() == 0
    passage = rows[71][1].split("\n")[1]
    assert len(passage.split()) == 55
    for r in got:
        text = next(x[1] for x in rows if x[0] == r.record.doc_id)
        expected = text if text is None else "\n".join(x for x in text.split("\n") if x != passage)
        assert r.record.text == expected
        assert r.n_dropped == (0 if text is None else text.count(passage))
    fields = [templates(f"Sent on <*> by {name} from the desk of the editor".split()) for name in ("Ann", "Bob")]
    assert set(fields[0]) & set(fields[1]) and fields[0][0] != fields[1][0]
    assert templates(["too", "short"]) == []


def test_varying_fields_are_one_template(spark):
    from quillmill.llm.lines import drop_boilerplate

    rng = random.Random(6)
    data = []
    for i in range(12):
        footer = f"This page was last changed on {i + 1} May 2020 at {i}:0{i % 6} by the friendly editor"
        data.append((i, "\n".join([sentence(rng, 12), footer, sentence(rng, 15)])))
    got = drop_boilerplate(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert all(r.n_dropped == 1 and "last changed" not in r.record.text and r.record.text.count("\n") == 1 for r in got)


def test_blocks_of_lines_go(spark):
    """Blocks of 2 and 3 lines at the head, in the middle and at the foot; near copies stay whole."""
    from quillmill.llm.lines import drop_boilerplate

    rng = random.Random(4)
    data, expected = [], {}
    for n in (2, 3):
        for at in (0, 2, 4):
            block = [sentence(rng, 10 + i) for i in range(n)]
            for _ in range(30):
                body = [sentence(rng, rng.randint(9, 20)) for _ in range(4)]
                expected[len(data)] = "\n".join(body)
                data.append((len(data), "\n".join([*body[:at], *block, *body[at:]])))
    original = [sentence(rng, 14).split() for _ in range(8)]
    for i in range(40):  # one word of one line differs, also a leading or a last one
        lines = [list(words) for words in original]
        lines[i % 8][i % 14] = f"other{sentence(rng, 1)}"
        expected[len(data)] = "\n".join(" ".join(words) for words in lines)
        data.append((len(data), expected[len(data)]))
    got = drop_boilerplate(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert {r.record.doc_id: r.record.text for r in got} == expected


# ---- quality


def test_quality_counts(docs, rows, empty):
    from quillmill.llm.quality import judge

    def plain(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        inside = set()
        for i in range(len(words) - 4):
            if windows[tuple(words[i : i + 5])] > 1:
                inside.update(range(i, i + 5))
        lines, dup = set(), 0
        for line in (text or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in lines
                lines.add(line)
        n = len(words)
        failed = n < 10 or 100 * len(inside) > 20 * n
        return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside), failed

    got = judge(clashing(docs)).collect()
    expected = [(r[0], *plain(r[1])) for r in rows]
    assert ordered(r[:7] for r in got) == ordered(expected)
    assert all(not r.kept for r in got if r.base_failed)
    assert judge(empty).count() == 0


def test_outliers_go_and_others_stay(spark):
    from quillmill.llm.quality import judge, keep_good

    rng = random.Random(7)
    data = [(i, "\n".join(sentence(rng, 15) for _ in range(rng.randint(2, 20))), "en", "hot" if i % 2 else f"s{i % 7}") for i in range(700)]
    copies = [(2000 + i, data[1][1], "en", "hot") for i in range(600)]  # a crowd of one text
    junk = [(1000 + i, " ".join(w + rng.choice(["***", "%%%", "$$$"]) for w in sentence(rng, 80).split()), "en", f"s{i % 7}") for i in range(40)]
    junk += [(1100 + i, sentence(rng, 90).upper().replace(" ", "!! "), "en", "hot") for i in range(40)]
    docs = spark.createDataFrame([*data, *copies, *junk], "doc_id long, text string, lang string, source string")
    kept = {r.id for r in judge(docs).collect() if r.kept}
    assert kept == {r[0] for r in [*data, *copies]}
    same = keep_good(clashing(docs))
    assert {r.doc_id for r in same.collect()} == kept and same.columns == clashing(docs).columns


# ---- pages


def test_pages():
    from quillmill.llm.pages import candidates, main_text

    page = (
        "<html><head><title>t</title><script>var a='</p>'</script></head><body><nav><a>menu</a></nav><div class='cookie-notice'>ok?</div>"
        "<header><h1>Site</h1></header><article><header><h1>Head &amp; line</h1><p>by me</p></header><p>One&nbsp; two<br>three <b>four"
        "<p>Five &lt;six&gt;<ul><li>a<li>b</ul><div class=ad>buy</div><section id='comments'><p>first!</p></section></article>"
        "<aside>side</aside><form>f</form><footer>foot</footer>"
    )
    assert main_text(page) == "Head & line\nOne two three four\nFive <six>\na\nb"
    assert main_text(None) == main_text("") == main_text("<p> </p>") == ""
    assert main_text("plain &amp; text") == "plain & text"
    assert main_text("<p>a &<i>lt</i> b, &am<b>p;</b> &lt;") == "a &lt b, &amp; <"
    assert main_text("<main><p>x</main><p>y") == "x"
    for odd in ("<" * 5000, "<a " * 5000, '<div class="a' * 5000, "<b>" * 20_000 + "x", "</p>" * 5000, "<![CDATA[", "<!--", "<article>" * 3000):
        main_text(odd), candidates(odd)


def test_site_templates_go(spark):
    from quillmill.llm.pages import extract

    rng = random.Random(3)
    shared = "<div><p>Read all about us and our friends here.</p></div>"
    pages = [(i, f"https://a.example.com/{i}", f"<body><div>{shared}<p>{sentence(rng, 20)}</p></div>{shared}</body>") for i in range(10)]
    pages += [(100 + i, "https://b.example.com/x", f"<body>{shared}<p>Only here {i}.</p></body>") for i in range(2)]
    copy = f"<body><p>{sentence(rng, 20)}</p></body>"
    pages += [(200 + i, "https://c.example.com/y", copy) for i in range(9)]  # copies aren't a template
    pages += [(300, None, "<p>no host"), (301, "https://a.example.com/n", None), (302, "::bad::", "<p>odd")]
    table = spark.createDataFrame([*pages, pages[0]], "page_id long, url string, html string").withColumn("template", F.lit(1)).withColumn("host", F.lit(1))
    got = extract(table).collect()
    assert len(got) == len(pages) + 1
    text = {r.id: r.text for r in got}
    assert all("friends" not in text[i] and text[i].endswith(".") and "\n" not in text[i] for i in range(10))
    assert text[100] == "Read all about us and our friends here.\nOnly here 0."
    assert all(text[200 + i] for i in range(9)) and text[300] == "no host" and text[301] == "" and text[302] == "odd"
    assert extract(table.limit(0)).count() == 0


def test_hosts(spark):
    from quillmill.llm.pages import host_of

    urls = {
        "https://A.example.com:80/x": "a.example.com", "//cdn.example.org/a": "cdn.example.org", "http://[2001:db8::1]:8/a": "[2001:db8::1]",
        " http://b.org?q@x": "b.org", "ftp://me@x:pw@c.org/": "c.org", "::bad::": "", "/path//only": "", None: "", "": "",
    }
    got = spark.createDataFrame([(u,) for u in urls], "url string").select("url", host_of("url").alias("host")).collect()
    assert {r.url: r.host for r in got} == urls


# ---- Jaccard join


def plain_classes(rows, k, num, den):
    def shingle(text):
        w = (text or "").encode().lower().split()
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])

    sets = [shingle(r[1]) for r in rows]
    part = list(range(len(rows)))

    def find(a):
        while part[a] != a:
            a = part[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                part[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(s), least.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("k, num, den", [(3, 90, 100), (5, 80, 100)])
def test_jaccard_classes(docs, rows, empty, k, num, den):
    from quillmill.llm.jaccard import join_classes, keep_one_of_each

    got = join_classes(clashing(docs), k, num, den).collect()
    expected = plain_classes(rows, k, num, den)
    assert ordered(r[:3] for r in got) == ordered(expected)
    assert join_classes(empty, k, num, den).count() == 0
    kept = keep_one_of_each(clashing(docs), k, num, den)
    assert kept.columns == clashing(docs).columns
    ids = [r.doc_id for r in kept.collect() if r.text and r.text.split()]
    assert sorted(ids) == sorted({e[2] for e in expected if e[1]})
    blank = sum(1 for r in rows if not (r[1] or "").split())
    assert kept.count() == len(ids) + blank


def test_jaccard_chains_and_large_regions(spark, monkeypatch):
    """Chains of small steps, many sets in one region, a crowd with several pivots and blocks."""
    from quillmill.llm import jaccard

    monkeypatch.setattr(jaccard, "SMALL", 3)
    monkeypatch.setattr(jaccard, "DIRECT", 3)
    monkeypatch.setattr(jaccard, "PER_PIVOT", 6)
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    rng = random.Random(11)
    common = [f"c{i}" for i in range(300)]
    data = []
    for chain in range(4):
        words = common[: 60 * (chain + 1)] + [f"w{rng.randint(0, 10**6)}" for _ in range(60)]
        for step in range(14):
            words = list(words)
            for _ in range(1 + chain % 3):
                words[rng.randrange(len(words))] = f"n{rng.randint(0, 10**9)}"
            data.append((rng.randint(0, 10**9), " ".join(words)))
    data += [(10**10 + i, " ".join(rng.sample(["p", "q", "r", "s"], 4) * rng.randint(1, 3))) for i in range(30)]
    table = spark.createDataFrame(data, "doc_id long, text string")
    for k, num, den in ((3, 90, 100), (1, 80, 100)):
        got = jaccard.join_classes(table, k, num, den).collect()
        assert ordered(r[:3] for r in got) == ordered(plain_classes(data, k, num, den))


def test_jaccard_near_copies_without_ids(spark):
    from quillmill.llm.jaccard import join_classes, keep_one_of_each

    rng = random.Random(12)
    data = []
    for ids in ((None, None, None), (None, 7), (None, None, 3)):
        words = sentence(rng, 120).split()
        for i, ident in enumerate(ids):
            changed = list(words)
            changed[30] = f"other{i}"
            data.append((ident, " ".join(changed)))
    data += [data[0], data[0], (None, sentence(rng, 40))]
    table = spark.createDataFrame(data, "doc_id long, text string")
    got = join_classes(table, 3, 90, 100).collect()
    assert ordered(r[:3] for r in got) == ordered(plain_classes(data, 3, 90, 100))
    assert ordered((r.doc_id,) for r in keep_one_of_each(table, 3, 90, 100).collect()) == ordered([(3,), (7,), (None,), (None,)])


def test_jaccard_keeps_rows_without_python(spark):
    """Whole rows don't pass through Python again; rows of one id are told apart by their texts."""
    from quillmill.llm.jaccard import keep_one_of_each

    rng = random.Random(13)
    one, two, three = (sentence(rng, 30).lower() for _ in range(3))
    data = [(1, one), (1, one.upper()), (1, two), (2, two), (2, f" {three}"), (2, three), (3, three), (None, one), (4, ""), (4, None), (4, None)]
    table = spark.createDataFrame(data, "doc_id long, text string")
    kept = keep_one_of_each(table, 5, 80, 100)
    assert "MapInArrow" not in kept._jdf.queryExecution().executedPlan().toString()
    assert ordered((r.doc_id, (r.text or "").lower().strip()) for r in kept.collect()) == ordered(
        [(1, one), (1, two), (2, three), (4, ""), (4, ""), (4, "")]
    )


def test_jaccard_texts_go_to_python_in_small_batches(spark, monkeypatch):
    """Steps that read whole texts get bounded batches; the session's setting is as before afterwards."""
    from quillmill.llm import jaccard
    from quillmill.session import BATCH_CONF, small_batches

    rng = random.Random(17)
    texts = [sentence(rng, 20) for _ in range(30)]
    table = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *(f"{t} end" for t in texts), texts[0]])], "doc_id long, text string")
    at, write, before = {}, jaccard.materialize, spark.conf.get(BATCH_CONF)

    def noted(df, name):
        at.setdefault(name, set()).add(int(spark.conf.get(BATCH_CONF)))
        return write(df, name)

    monkeypatch.setattr(jaccard, "materialize", noted)
    found = {r.id: r.component_id for r in jaccard.join_classes(table, 3, 90, 100).collect()}
    assert found == {i: i % 30 for i in range(61)}
    assert at["signatures"] == at["distances"] == {jaccard.TEXTS} and at["regions"] == {int(before)}
    assert spark.conf.get(BATCH_CONF) == before and jaccard.KNOWN_WORDS <= 1 << 16
    with small_batches(spark, 3):
        again = {r.id: r.component_id for r in jaccard.join_classes(table, 3, 90, 100).collect()}
        assert again == found and spark.conf.get(BATCH_CONF) == "3"
    with pytest.raises(KeyError), small_batches(spark, 3):
        raise KeyError
    assert spark.conf.get(BATCH_CONF) == before


def test_jaccard_regions_send_on_only_near_pairs(spark):
    """Long sets without anything in common, and near copies below the threshold, stay in their region."""
    import numpy as np

    from quillmill.llm.jaccard import close_pairs, own_width, sketch_of

    rng = np.random.default_rng(3)
    draw = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    sets = [draw(5000) for _ in range(12)]
    origin = draw(300)
    sets += [np.concatenate([origin[25:], draw(25)]) for _ in range(1)] + [np.concatenate([rng.permutation(origin)[45:], draw(45)]) for _ in range(12)]
    linked = {}
    for size in (40, 300, 760, 5000):
        a = draw(size)
        b = np.concatenate([a[: size - size // 25], draw(size // 25)])  # a wider sketch may meet a narrower one
        linked[len(sets)] = len(sets) + 1
        sets += [a, b[: size - size // 50]]
    both = lambda a, b: len(np.intersect1d(a, b))
    exact = {(i, j) for j in range(len(sets)) for i in range(j) if 100 * both(sets[i], sets[j]) >= 90 * (len(sets[i]) + len(sets[j]) - both(sets[i], sets[j]))}
    assert set(linked.items()) <= exact
    rows = [(i, len(s), bytearray(sketch_of(s, own_width(len(s))))) for i, s in enumerate(sets)]
    table = spark.createDataFrame(rows, "node long, n long, sketch binary")
    members = spark.createDataFrame([(r, i, i) for r in (1, 2) for i in range(len(sets))], "region long, x long, comp long")
    got = [tuple(r) for r in close_pairs(members, table, 90, 100).collect()]
    assert exact <= set(got) and len(got) == 2 * len(set(got))
    assert len(set(got)) <= len(exact) + 10
    joined = spark.createDataFrame([(r, i, 0) for r in (1, 2) for i in range(len(sets))], "region long, x long, comp long")
    assert close_pairs(joined, table, 90, 100).isEmpty()


def test_jaccard_close_pairs_reach_over_batches(spark, monkeypatch):
    import numpy as np

    from quillmill.llm import jaccard

    rng = np.random.default_rng(4)
    sketches = [bytes(rng.integers(0, 256, 256, dtype=np.uint8)) for _ in range(6)]
    rows = [(10 * i + j, 100, bytearray(s)) for i, s in enumerate(sketches) for j in range(4)]
    table = spark.createDataFrame(rows, "node long, n long, sketch binary")
    members = spark.createDataFrame([(x // 10, x, x) for x, _, _ in rows], "region long, x long, comp long")
    monkeypatch.setattr(jaccard, "PAIRS", 2)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = sorted(tuple(r) for r in jaccard.close_pairs(members, table, 90, 100).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == sorted((10 * i + a, 10 * i + b) for i in range(6) for b in range(4) for a in range(b))


def test_jaccard_pivots_without_a_row_for_each_byte(spark, monkeypatch):
    import numpy as np

    from quillmill.llm import jaccard

    monkeypatch.setattr(jaccard, "TALLIED", 3)  # a region's counts come from several tasks
    rng = np.random.default_rng(5)
    rows = [(i % 3 - 1, i, bytearray(rng.integers(250, 256, jaccard.SKETCH, dtype=np.uint8).tobytes())) for i in range(40)]
    table = spark.createDataFrame(rows, "region long, x long, sketch binary")
    found = jaccard.commonest(table)
    assert "explode" not in found._jdf.queryExecution().toString().lower()
    got = {r.region: bytes(r.common) for r in found.collect()}
    expected = {}
    for region in (-1, 0, 1):
        columns = zip(*[r[2] for r in rows if r[0] == region])
        expected[region] = bytes(max(((c.count(b), b) for b in set(c)))[1] for c in columns)
    assert got == expected
    assert jaccard.commonest(table.where("region > 5")).isEmpty()


def test_sketches_never_exceed_the_difference():
    import numpy as np

    from quillmill.llm.jaccard import sketch_of

    rng = np.random.default_rng(2)
    for _ in range(200):
        whole = np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 900)), dtype=np.uint64))
        part = whole[rng.random(len(whole)) < rng.random()]
        differ = sum(a != b for a, b in zip(sketch_of(whole), sketch_of(part)))
        assert differ <= len(whole) - len(part)


def test_region_keys_miss_no_partner():
    import numpy as np

    from quillmill.llm.jaccard import region_keys

    rng = np.random.default_rng(1)
    for _ in range(400):
        size = int(rng.integers(1, 120))
        whole = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        for num, den in ((80, 100), (90, 100)):
            cut = int(len(whole) * (den - num) / den)
            part = whole[: len(whole) - cut] if cut else whole
            if len(part) * den >= num * len(whole):
                assert set(region_keys(whole, num, den).tolist()) & set(region_keys(part, num, den).tolist())


@pytest.mark.parametrize("num", [79, 50, 0, 101])
def test_jaccard_thresholds_it_would_miss_raise(num):
    from quillmill.llm.jaccard import join_classes

    with pytest.raises(ValueError):
        join_classes(None, 3, num, 100)
