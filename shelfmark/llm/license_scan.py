"""Licences that texts name: by identifier tags with an expression behind them, and by phrases of notices.

One Aho-Corasick automaton holds the words of all phrases and tags and reads the words of a text once.
Where it meets a tag, the expression that follows is read by the shunting-yard rule:
`with` binds closer than `and`, and that closer than `or`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfmark.llm.plain_words import byte_parts, plain_words

#: Phrases that state a licence, in plain words, and the label of each.
NOTICES = {
    "under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache license version 2": "apache-2",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "boost software license": "bsl-1",
    "mozilla public license version 2": "mpl-2",
    "eclipse public license": "epl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "cc by 4 0": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "reserved",
}
TAGS = ("SPDX-License-Identifier:",)

#: What a licence asks of who uses the text, from least to most; `unknown` asks most, to be safe.
TERMS = ("permissive", "weak copyleft", "copyleft", "network copyleft", "restricted", "unknown")
#: Beginnings of labels and the place of their terms in TERMS; the first that fits counts.
FAMILIES = (
    (("mit", "apache", "bsd", "isc", "bsl", "0bsd", "zlib", "unlicense", "cc0", "cc-by-4", "public-domain", "python", "postgresql"), 0),
    (("lgpl", "mpl", "epl", "cddl"), 1),
    (("agpl", "sspl"), 3),
    (("cc-by-nc", "cc-by-nd", "reserved"), 4),
    (("gpl", "cc-by-sa", "osl"), 2),
    (("cc-by",), 0),
)
EXPRESSION = re.compile(rb"[ \t]*[\"']?([a-z0-9.+() \t-]*)")
PIECE = re.compile(r"[()]|[a-z0-9.+-]+")
STRENGTH = {"with": 3, "and": 2, "or": 1}
#: Words of an expression that say there is no licence to name.
NO_LICENCE = ("none", "noassertion")


class Licence(NamedTuple):
    """The value of an expression: labels in it, its terms, and whether it is a bare identifier (and which)."""

    labels: frozenset[str]
    terms: int
    bare: str | None = None


def label_of(identifier: str) -> str:
    """A label names a licence without `only`, `or later`, a version's `.0` and a public licence's version."""
    label = re.sub(r"(-only|-or-later|\+)$", "", identifier)
    return re.sub(r"-\d+(\.\d+)*$", "", label) if label.startswith("cc") else re.sub(r"\.0$", "", label)


def terms_of(label: str) -> int:
    return next((terms for names, terms in FAMILIES if label.startswith(names)), len(TERMS) - 1)


def applied(operator: str, left: Licence, right: Licence) -> Licence | None:
    """The value of `left operator right`; None where an exception is not bare, or is added to no bare licence."""
    if operator == "with":
        if left.bare is None or right.bare is None:
            return None
        return Licence(left.labels, 1 if left.terms in (2, 3) else left.terms)
    chosen = max(left.terms, right.terms) if operator == "and" else min(left.terms, right.terms)
    return Licence(left.labels | right.labels, chosen)


def evaluated(expression: str) -> Licence | None:
    """The licences of an expression in lower case, with its terms: the easiest choice of an `or`, all of an `and`.

    None where it is no expression: empty, a word too much or missing, a bracket left open.
    """
    values: list[Licence] = []
    waiting: list[str] = []
    operand_next = True

    def reduce() -> bool:
        operator, right, left = waiting.pop(), values.pop(), values.pop()
        if (value := applied(operator, left, right)) is None:
            return False
        values.append(value)
        return True

    for piece in PIECE.findall(expression):
        if piece == "(" or (piece not in STRENGTH and piece != ")"):
            if not operand_next:
                return None
            if piece == "(":
                waiting.append(piece)
                continue
            label = label_of(piece)
            known = frozenset(() if piece in NO_LICENCE else (label,))
            values.append(Licence(known, terms_of(label), piece))
            operand_next = False
        elif operand_next:
            return None
        elif piece == ")":
            while waiting and waiting[-1] != "(":
                if not reduce():
                    return None
            if not waiting:
                return None
            waiting.pop()
            values[-1] = values[-1]._replace(bare=None)
        else:
            while waiting and waiting[-1] != "(" and STRENGTH[waiting[-1]] >= STRENGTH[piece]:
                if not reduce():
                    return None
            waiting.append(piece)
            operand_next = True
    if operand_next:
        return None
    while waiting:
        if waiting[-1] == "(" or not reduce():
            return None
    return values[0]


def expressions(lower: bytes, tags: Sequence[bytes]) -> Iterator[str]:
    """What follows each tag, up to the first character that no expression has, or the next tag."""
    behind = list(re.finditer(b"|".join(map(re.escape, tags)), lower))
    for tag, after in zip(behind, [*(m.start() for m in behind[1:]), len(lower)]):
        yield EXPRESSION.match(lower, tag.end(), after).group(1).decode().rstrip(" \t-")


def automaton(phrases: Mapping[str, str], tags: Sequence[str]) -> ahocorasick.Automaton:
    """Finds the words of phrases, each between two blanks, and of tags (which have no label)."""
    found = ahocorasick.Automaton()
    for phrase, label in [*phrases.items(), *((t, None) for t in tags)]:
        words = plain_words(phrase.encode())
        if not words:
            raise ValueError(f"no word in {phrase!r}")
        found.add_word(f" {b' '.join(words).decode('latin-1')} ", (phrase, label, len(words)))
    if len(found):
        found.make_automaton()
    return found


OUT = (
    "n_words long, places array<struct<phrase:string,label:string,first:bigint,last:bigint>>, "
    "expressions array<struct<expression:string,valid:boolean,labels:array<string>,terms:string>>, "
    "labels array<string>, terms string, score double"
)


def license_scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = NOTICES,
    tags: Sequence[str] = TAGS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_words, places, expressions, labels, terms, score) of every text.

    `places` are all places of all phrases (first and last word, from 0), `expressions` what
    follows the tags, `labels` the distinct labels of both in order, and `terms` what they
    ask all together (null without any). The score tells how sure a licence is named: 1 for a
    tag with an expression that can be read, 0.9 for a phrase of four words or more, 0.6 for a
    shorter one, 0 for none. An expression that cannot be read has no labels.

    A null text has no words; a null id stays; repeated rows each return; a phrase over the end of
    one line and the start of the next counts; other columns are dropped, an empty table gives an
    empty one. Every text is read whole, in one task; nothing is shuffled.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    lean = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    lowered = [t.lower().encode() for t in tags]
    held = dict(phrases)
    automaton(held, tags)  # a phrase without a word is an error here, not in a task

    def scanned(raw: bytes, machine: ahocorasick.Automaton) -> dict:
        words = plain_words(raw)
        joined = b" %s " % b" ".join(words)
        places, tagged, seen, at = [], False, 0, 0
        hits = machine.iter(joined.decode("latin-1")) if len(machine) else ()
        for end, (phrase, label, n) in hits:
            seen += joined.count(b" ", at, end)  # blanks before this one: the words up to here
            at = end
            if label is None:
                tagged = True
            else:
                places.append({"phrase": phrase, "label": label, "first": seen - n, "last": seen - 1})
        said = []
        for expression in expressions(raw.lower(), lowered) if tagged else ():
            value = evaluated(expression)
            said.append(
                {"expression": expression, "valid": value is not None, "labels": sorted(value.labels) if value else [], "terms": TERMS[value.terms] if value else None}
            )
        labels = sorted({p["label"] for p in places}.union(*(e["labels"] for e in said)))
        asked = [terms_of(p["label"]) for p in places] + [TERMS.index(e["terms"]) for e in said if e["labels"]]
        sure = [0.9 if p["last"] - p["first"] >= 3 else 0.6 for p in places] + [1.0 for e in said if e["labels"]]
        return {
            "n_words": len(words), "places": places, "expressions": said, "labels": labels,
            "terms": TERMS[max(asked)] if asked else None, "score": max(sure, default=0.0),
        }

    place = pa.struct([("phrase", pa.string()), ("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())])
    said = pa.struct([("expression", pa.string()), ("valid", pa.bool_()), ("labels", pa.list_(pa.string())), ("terms", pa.string())])
    kinds = {"n_words": pa.int64(), "places": pa.list_(place), "expressions": pa.list_(said), "labels": pa.list_(pa.string()), "terms": pa.string(), "score": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(held, tags)
        for batch in batches:
            for part, texts in byte_parts(batch):
                found = [scanned(raw, machine) for raw in texts]
                columns = [pa.array([f[name] for f in found], k) for name, k in kinds.items()]
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], ["id", *kinds])

    return lean.mapInArrow(run, f"id {kind}, {OUT}").withColumnRenamed("id", id_col)
