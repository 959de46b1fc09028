"""Licence scans, phrase mining and the Merkle manifest against plain versions, with every odd case."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def clashing(docs):
    for name in ("id", "tree", "leaf", "changed", "pos", "seg", "n", "root", "word", "words", "high", "low", "labels", "score", "block"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    vocabulary = ["ka", "Lo", "mi", "nu", "pe", "é中", "ra so", "x" * 300]
    marks = [" ", " ", " ", " ", "\t", ". ", ", ", "\n", "\r\n", " ; ", "! ", "  "]
    texts = ["".join(rng.choice(vocabulary[: 2 + i % 7]) + rng.choice(marks) for _ in range(rng.randint(1, 120))) for i in range(150)]
    texts += ["Released under the MIT License. under the mit license", "CC BY-NC-SA 4.0", "Apache License, Version 2.0", "under the  MIT-license"]
    texts += ["# SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0\nka lo mi\n", "License: none of your business", "SPDX-License-Identifier: Foo"]
    texts += ["", " \n\t ", "one", "ka lo " * 30_000, "a" * 200_000 + " under the MIT license", "\n\n\n"]
    out = [(i, t, rng.choice(["en", "de", None, "und"]), None if i % 7 == 0 else "hot" if i % 3 == 0 else f"s{i % 4}", len(t)) for i, t in enumerate(texts)]
    out += [(len(out), None, None, None, None), (900, texts[3], "en", "alone", 1), (None, texts[5], "en", "hot", 1), (None, "z\n", "en", "s1", 1)]
    out += [out[4]] * 40 + [out[-1]] * 2 + [(8, "other text of one id", "fr", "hot", None), (8, "and\nanother", "fr", "hot", 0)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- licences

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def plain_licences(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


def test_licence_places_are_those_of_the_definition(docs, rows, empty):
    from quillmill.llm.licences import scan_licences

    got = scan_licences(clashing(docs)).collect()
    expected = Counter((r[0], *plain_licences(r[1])) for r in rows)
    assert Counter((r.id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == expected
    for r in got:
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
    assert scan_licences(empty).collect() == []


def test_overlapping_phrases_all_count():
    from quillmill.llm.licences import phrase_automaton, scan, tag_automaton

    automata = phrase_automaton(), tag_automaton()
    rng = random.Random(2)
    pieces = ["cc by nc", "by nc", "under the mit license", "mit license", "apache license version 2", "é", "cc", "Under", "CC-BY-NC/"]
    for _ in range(300):
        text = rng.choice([" ", "-", "\n"]).join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        assert scan(text, *automata)[:5] == plain_licences(text), text


def test_expressions_are_evaluated():
    from quillmill.llm.licences import parse

    cases = {
        "mit": ({"mit"}, 1),
        "mit or gpl-2.0-only and apache-2.0": ({"mit", "gpl-2", "apache-2"}, 1),
        "(mit or gpl-2.0-only) and agpl-3.0+": ({"mit", "gpl-2", "agpl-3-or-later"}, 4),
        "gpl-2.0-or-later with classpath-exception-2.0 and mit": ({"gpl-2-or-later-with-classpath-exception-2.0", "mit"}, 2),
        "((cc-by-nc-4.0))": ({"cc-by-nc"}, 5),
        "licenseref-acme": ({"licenseref-acme"}, 5),
        "bsd-3-clause": ({"bsd-3-clause"}, 1),
    }
    for text, (labels, demand) in cases.items():
        assert parse(text.encode()) == (frozenset(labels), demand), text
    for text in ("", "mit apache-2.0", "mit or", "or mit", "(mit", "mit)", "()", "mit with apache-2.0", "(mit or isc) with x-exception", "unheard-of", "mit and unheard-of"):
        assert parse(text.encode()) is None, text


def test_demand_by_truth_table():
    """and takes the stricter, or the milder side, with the usual precedence."""
    from quillmill.llm.licences import KNOWN, parse

    rng = random.Random(4)
    names = ["mit", "mpl-2.0", "gpl-3.0", "agpl-3.0", "busl-1.1"]
    rank = {n: KNOWN[n.split("-")[0]] for n in names}

    def made(depth):
        if depth == 0 or rng.random() < 0.3:
            n = rng.choice(names)
            return n, f"R[{n!r}]"
        (a, pa), (b, pb) = made(depth - 1), made(depth - 1)
        return (f"({a}) and ({b})", f"max({pa},{pb})") if rng.random() < 0.5 else (f"({a} or {b})", f"min({pa},{pb})")

    for _ in range(200):
        text, rule = made(4)
        assert parse(text.encode())[1] == eval(rule, {"R": rank, "max": max, "min": min}), text


def test_tags_and_notices(spark):
    from quillmill.llm.licences import licence_report, scan_licences

    texts = [
        (1, "/* SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 */", "a"),
        (2, '{"license": "MIT OR Apache-2.0",\n"x": 1}', "a"),
        (3, "This work is licensed under the GNU General Public License, version 3.", "b"),
        (4, "license: see the file", "b"),
        (5, "SPDX-License-Identifier: whatever\n", "b"),
        (6, None, None),
    ]
    scanned = scan_licences(spark.createDataFrame(texts, "doc_id long, text string, part string"))
    got = {r.id: (r.labels, r.demand, r.n_expressions, r.n_unparsed) for r in scanned.collect()}
    assert got == {
        1: ("gpl-2-with-classpath-exception-2.0", "weak copyleft", 1, 0),
        2: ("apache-2,mit", "permissive", 1, 0),
        3: ("gpl-3", None, 0, 0),
        4: ("", None, 0, 0),
        5: ("", None, 0, 1),
        6: ("", None, 0, 0),
    }
    report = {r.label: r.documents for r in licence_report(scanned).collect()}
    assert report == {"gpl-2-with-classpath-exception-2.0": 1, "apache-2": 1, "mit": 1, "gpl-3": 1}


# ---- phrases


def plain_collocations(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if 2 <= len(p) and a >= least}
        kept = []
        for p, a in found.items():
            inside = any(
                len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in found.items()
            )
            if not inside:
                score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("top,block", [(2000, 4 << 20), (7, 500)])
def test_collocations_equal_brute_force(docs, rows, empty, monkeypatch, top, block):
    from quillmill.llm import phrases

    monkeypatch.setattr(phrases, "BLOCK", block)
    got = sorted(tuple(r) for r in phrases.collocations(clashing(docs), top).collect())
    expected = plain_collocations(rows, 30, top)
    assert len(expected) >= 14 and got == expected
    assert phrases.collocations(empty, top).collect() == []


def test_a_full_filter_only_costs_time(docs, rows, monkeypatch):
    from quillmill.llm import phrases

    monkeypatch.setattr(phrases, "MAX_BITS", 64)
    assert sorted(tuple(r) for r in phrases.collocations(docs, 50).collect()) == plain_collocations(rows, 30, 50)


def test_scores_beyond_64_bits(spark):
    from quillmill.llm.phrases import scored

    big = 7_000_000_000_000_000_000
    words = spark.createDataFrame([(1 << 32, 0, big), (2 << 32, 0, big + 3)], "high long, low long, uses long")
    pairs = spark.createDataFrame([((1 << 32) | 2, 0, big - 1)], "high long, low long, uses long")
    none = spark.createDataFrame([], "high long, low long, uses long")
    assert [r.score for r in scored([words, pairs, none, none]).collect()] == [2_000_000 * (big - 1) // (2 * big + 3)]


# ---- Merkle manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def packed(values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def plain_tree(leaves):
    """(root, siblings of each leaf, level by level)."""
    groups = [[i] for i in range(len(leaves))]
    siblings = [[] for _ in leaves]
    while len(leaves) > 1:
        level, merged = [], []
        for i in range(0, len(leaves), 3):
            run = leaves[i : i + 3]
            for at, group in enumerate(groups[i : i + 3]):
                for leaf in group:
                    siblings[leaf].append((run[:at], run[at + 1 :]))
            level.append(H(*run))
            merged.append([x for g in groups[i : i + 3] for x in g])
        leaves, groups = level, merged
    return leaves[0], siblings


def plain_manifest(rows):
    by = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        even = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        leaf = H(packed([doc_id, source, lang, n_chars, text]))
        other = H(packed([doc_id, source, lang, n_chars, None if text is None else text.replace("\n", "")]))
        by[source].append(((doc_id is not None, doc_id or 0, leaf), doc_id, leaf, other if even else leaf))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        by[source].sort(key=lambda r: r[0])
        trees[source] = plain_tree([r[2] for r in by[source]])
    root, above = plain_tree([trees[s][0] for s in order])
    out = []
    for source, top in zip(order, above):
        subroot, siblings = trees[source]
        for (_, doc_id, leaf, changed), path in zip(by[source], siblings):
            at = changed
            for before, after in path + top:
                at = H(*before, at, *after)
            proof = H(*[x for before, after in path + top for x in before + after])
            out.append((doc_id, leaf, subroot, root, proof, at, at == root))
    return out


def op13(spark, docs, tmp_path):
    from quillmill.llm.merkle import op13_merkle_manifest

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return [tuple(r) for r in op13_merkle_manifest(spark, str(tmp_path)).collect()]


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_manifest_equals_brute_force(spark, docs, rows, tmp_path, monkeypatch, depth):
    """Also with small records, so that proofs descend through several of them."""
    from quillmill.llm import merkle

    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "SPAN", 3**depth)
    got = op13(spark, clashing(docs), tmp_path)
    expected = plain_manifest(rows)
    assert Counter(got) == Counter(expected)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 10, 28])
def test_manifest_of_small_tables(spark, tmp_path, n):
    rows = [(i, f"t\n{i}", "en", None, i) for i in range(n)]
    got = op13(spark, spark.createDataFrame(rows, SCHEMA), tmp_path)
    assert Counter(got) == Counter(plain_manifest(rows) if n else [])


def test_manifest_of_many_groups(spark, tmp_path):
    rows = [(i, None, None, f"g{i % 800}", None) for i in range(1000)]
    assert Counter(op13(spark, spark.createDataFrame(rows, SCHEMA), tmp_path)) == Counter(plain_manifest(rows))
