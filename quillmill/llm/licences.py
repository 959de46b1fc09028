"""Licence scans: identifier tags and notice phrases by Aho-Corasick, expressions by a shunting yard.

One automaton runs over the words of a text (lower-cased ASCII, other characters as they are) and
finds notice phrases; another runs over its lines and finds tags that introduce a licence
expression. An expression is brought into postfix form by operator precedence (``with`` binds
closest, then ``and``, then ``or``) and evaluated: to the licences it names, and to what it asks of
a user, where ``and`` takes the stricter and ``or`` the milder side.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import read
from quillmill.llm.registry import query

# Phrases and labels of the contract.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Wording of common licence notices.
NOTICES = {
    "apache license 2": "apache-2",
    "apache software license": "apache-2",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "the mit license": "mit",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu gpl version 2": "gpl-2",
    "gnu gpl version 3": "gpl-3",
    "gnu lesser general public license version 2": "lgpl-2",
    "gnu lesser general public license version 3": "lgpl-3",
    "gnu affero general public license version 3": "agpl-3",
    "mozilla public license version 2": "mpl-2",
    "mozilla public license v 2": "mpl-2",
    "eclipse public license": "epl",
    "bsd 2 clause license": "bsd-2-clause",
    "bsd 3 clause license": "bsd-3-clause",
    "redistribution and use in source and binary forms": "bsd",
    "boost software license": "bsl",
    "isc license": "isc",
    "the unlicense": "unlicense",
    "creative commons zero": "cc0",
    "cc0 1 0": "cc0",
    "dedicated to the public domain": "public-domain",
    "creative commons attribution 4 0": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "cc by 4 0": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "all rights reserved": "proprietary",
}

# Tags that a licence expression follows; the weak ones only count if all of it is known.
TAGS = {"spdx-license-identifier:": True, "license-expression:": False, "license:": False, "licence:": False, '"license":': False}

# Public short identifiers (without version and suffix) and what they ask of a user.
PERMISSIVE, WEAK, STRONG, NETWORK, RESTRICTED = range(1, 6)
KNOWN = {
    "0bsd": PERMISSIVE,
    "afl": PERMISSIVE,
    "apache": PERMISSIVE,
    "artistic": PERMISSIVE,
    "bsd-2-clause": PERMISSIVE,
    "bsd-3-clause": PERMISSIVE,
    "bsl": PERMISSIVE,
    "cc-by": PERMISSIVE,
    "cc0": PERMISSIVE,
    "isc": PERMISSIVE,
    "mit": PERMISSIVE,
    "mit-0": PERMISSIVE,
    "ncsa": PERMISSIVE,
    "ofl": PERMISSIVE,
    "postgresql": PERMISSIVE,
    "psf": PERMISSIVE,
    "python": PERMISSIVE,
    "unlicense": PERMISSIVE,
    "wtfpl": PERMISSIVE,
    "zlib": PERMISSIVE,
    "cddl": WEAK,
    "cpl": WEAK,
    "epl": WEAK,
    "eupl": WEAK,
    "lgpl": WEAK,
    "mpl": WEAK,
    "ms-pl": WEAK,
    "cc-by-sa": STRONG,
    "gfdl": STRONG,
    "gpl": STRONG,
    "osl": STRONG,
    "agpl": NETWORK,
    "sspl": NETWORK,
    "busl": RESTRICTED,
    "cc-by-nc": RESTRICTED,
    "cc-by-nc-nd": RESTRICTED,
    "cc-by-nc-sa": RESTRICTED,
    "cc-by-nd": RESTRICTED,
}
DEMANDS = {PERMISSIVE: "permissive", WEAK: "weak copyleft", STRONG: "copyleft", NETWORK: "network copyleft", RESTRICTED: "restricted"}

# Weights of a finding; what remains doubtful is the product of 1 - weight over distinct labels and expressions.
BASE_WEIGHT, NOTICE_WEIGHT, STRONG_TAG_WEIGHT, WEAK_TAG_WEIGHT = 0.9, 0.75, 0.9, 0.6
#: Parsed expressions that a task keeps for reuse.
PARSED = 4096

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_TOKEN = re.compile(rb"[()]|[0-9a-z.+-]+")
_BLANKS = re.compile(rb"[\x20\x09\"']*")
_STOP = re.compile(rb"[^\x20\x09()0-9a-z.+-]")
_ID = re.compile(r"(?P<name>[a-z][a-z0-9-]*?|0bsd)(?:-v?(?P<major>[0-9]+)(?:\.[0-9]+)*)?(?P<later>-only|-or-later|\+)?")
_BINDS = {"or": 1, "and": 2, "with": 3}


def licence_of(token: str) -> tuple[str, int] | None:
    """(label, demand) of a short identifier; None if it isn't known."""
    if token.startswith("licenseref-"):
        return token, RESTRICTED
    whole = token.removesuffix("-only").removesuffix("-or-later").removesuffix("+")
    if whole in KNOWN:
        return whole, KNOWN[whole]
    match = _ID.fullmatch(token)
    if not match or match["name"] not in KNOWN:
        return None
    name, major, later = match["name"], match["major"], match["later"]
    # versions tell apart the families that are known by them
    versioned = major and not name.startswith("cc")
    label = f"{name}-{major}" if versioned else name
    return label + ("-or-later" if later in ("+", "-or-later") and versioned else ""), KNOWN[name]


def postfix(tokens: list[str]) -> list[str] | None:
    """The tokens in postfix order by a shunting yard; None if they are no expression."""
    out: list[str] = []
    waiting: list[str] = []
    operand_due = True
    for token in tokens:
        if token in _BINDS:
            if operand_due:
                return None
            while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= _BINDS[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand_due = True
        elif token == "(":
            if not operand_due:
                return None
            waiting.append(token)
        elif token == ")":
            if operand_due:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        else:
            if not operand_due:
                return None
            out.append(token)
            operand_due = False
    if operand_due or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(order: list[str]) -> tuple[frozenset[str], int] | None:
    """(labels, demand) of a postfix expression; None if a licence isn't known or ``with`` lacks an exception.

    An exception turns copyleft into weak copyleft and marks the label of its licence.
    """
    stack: list[tuple[frozenset[str], int, str | None]] = []  # the last: the token, for a lone identifier
    for token in order:
        if token not in _BINDS:
            stack.append((frozenset(), 0, token))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            licence = licence_of(left[2]) if left[2] else None
            if licence is None or right[2] is None or "exception" not in right[2]:
                return None
            stack.append((frozenset([f"{licence[0]}-with-{right[2]}"]), WEAK if licence[1] in (STRONG, NETWORK) else licence[1], None))
            continue
        sides = [_resolved(left), _resolved(right)]
        if None in sides:
            return None
        demand = (max if token == "and" else min)(sides[0][1], sides[1][1])
        stack.append((sides[0][0] | sides[1][0], demand, None))
    return _resolved(stack[0])


def _resolved(value: tuple[frozenset[str], int, str | None]) -> tuple[frozenset[str], int] | None:
    if value[2] is None:
        return value[:2]
    licence = licence_of(value[2])
    return licence and (frozenset([licence[0]]), licence[1])


@lru_cache(maxsize=PARSED)
def parse(expression: bytes) -> tuple[frozenset[str], int] | None:
    """(labels, demand) of an expression in lower case; None if it is none, or names what isn't known."""
    order = postfix([t.decode() for t in _TOKEN.findall(expression)])
    return evaluate(order) if order else None


def expression_at(line: bytes) -> bytes:
    """What may be an expression at the start of ``line``: up to a character that can't be in one.

    A full stop at the end belongs to the sentence.
    """
    line = line[_BLANKS.match(line).end() :]
    stop = _STOP.search(line)
    return line[: stop.start() if stop else len(line)].strip(b" \t").rstrip(b".")


def _automaton(phrases: dict) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, value in phrases.items():
        found.add_word(phrase, (phrase, value))
    found.make_automaton()
    return found


def phrase_automaton() -> ahocorasick.Automaton:
    """Finds `` phrase `` in words joined by single blanks; the value is (label, is a base phrase)."""
    phrases = {f" {p} ": (label, False) for p, label in NOTICES.items()}
    return _automaton(phrases | {f" {p} ": (label, True) for p, label in BASE.items()})


def tag_automaton() -> ahocorasick.Automaton:
    return _automaton(TAGS)


def scan(text: str, phrases: ahocorasick.Automaton, tags: ahocorasick.Automaton) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, demand, n_expressions, n_unparsed, score) of a text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.translate(_WORDS).split()
    base, noticed, first, last, n_base = set(), set(), None, None, 0
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1")  # one character a byte, as in the phrases
    upto = place = 0
    for end, (phrase, (label, is_base)) in phrases.iter(joined):
        if not is_base:
            noticed.add(label)
            continue
        start = end - len(phrase) + 1
        if start >= upto:  # blanks up to here are counted once, and back only within a phrase
            place += joined.count(" ", upto, start)
        else:
            place -= joined.count(" ", start, upto)
        upto = start
        base.add(label)
        n_base += 1
        first = place if first is None else min(first, place)
        last = place if last is None else max(last, place)
    expressions, weak, unparsed, n = set(), set(), 0, 0
    demand = 0
    lower = raw.translate(_LOWER)
    if b"licen" in lower:
        for end, (_, strong) in tags.iter(lower.decode("latin-1")):
            stop = lower.find(b"\n", end)
            found = parse(expression_at(lower[end + 1 : stop if stop >= 0 else len(lower)]))
            if found is None:
                unparsed += strong
                continue
            n += 1
            demand = max(demand, found[1])
            (expressions if strong else weak).update(found[0])
    doubt = (1 - BASE_WEIGHT) ** len(base) * (1 - NOTICE_WEIGHT) ** len(noticed - base)
    doubt *= (1 - STRONG_TAG_WEIGHT) ** len(expressions) * (1 - WEAK_TAG_WEIGHT) ** len(weak - expressions)
    labels = base | noticed | expressions | weak
    return (
        len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)),
        DEMANDS.get(demand), n, unparsed, round(1 - doubt, 12),
    )


_SCANNED = [
    ("n_words", pa.int64(), "bigint"),
    ("n_base", pa.int64(), "bigint"),
    ("first_word", pa.int64(), "bigint"),
    ("last_word", pa.int64(), "bigint"),
    ("base_labels", pa.string(), "string"),
    ("labels", pa.string(), "string"),
    ("demand", pa.string(), "string"),
    ("n_expressions", pa.int64(), "bigint"),
    ("n_unparsed", pa.int64(), "bigint"),
    ("score", pa.float64(), "double"),
]


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, demand, n_expressions, n_unparsed, score).

    ``labels`` are those of base phrases, notices and tagged expressions, sorted and comma-joined
    (empty if none). ``demand`` is what all tagged expressions together ask of a user, null without
    one; ``n_unparsed`` counts plain identifier tags without a known expression. ``score`` is 0 for a
    text without a finding and nears 1 with more. Null texts are empty; texts of any length are
    scanned whole, in time proportional to their length; repeated rows and ids stay; other columns
    aren't read; no rows give no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, tags = phrase_automaton(), tag_automaton()
        for batch in batches:
            made = [scan(text.as_py(), phrases, tags) for text in batch.column("text")]
            columns = list(zip(*made)) or [()] * len(_SCANNED)
            arrays = [pa.array(values, kind) for values, (_, kind, _) in zip(columns, _SCANNED)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], ["id", *[name for name, _, _ in _SCANNED]])

    return rows.mapInArrow(run, f"id {id_type}, " + ", ".join(f"{name} {kind}" for name, _, kind in _SCANNED))


def licence_report(scanned: DataFrame, by: str | None = None) -> DataFrame:
    """(label, documents, words) of scanned documents, and per ``by`` if given: what a corpus owes to which licence."""
    keys = [by] if by else []
    each = scanned.where(F.col("labels") != "").select(*keys, "n_words", F.explode(F.split("labels", ",")).alias("label"))
    return each.groupBy(*keys, "label").agg(F.count("*").alias("documents"), F.sum("n_words").alias("words"))


@query("op11_licences")
def op11_licences(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licences(docs).withColumnRenamed("id", "doc_id")
