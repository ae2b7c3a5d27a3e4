"""Operator 10: licence scans by sentence rules.

A text is cut into sentences, its wrapped lines joined and comment signs taken off; each is normalised
and mapped to the identifiers of the known licence sentences in it.  The sequence of identifiers is then
matched against ordered rules: the first rule that fits at a place names the licence and uses its
sentences up.  An SPDX line gives its whole expression.
"""

from __future__ import annotations

import re
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import parts, texts

# Known licence sentences in normalised form (lower case, "license", single spaces),
# identifier -> pattern; where two overlap in a sentence, the one that stands first here counts.
SENTENCES = {
    "apache-title": r"\bapache license,? version 2\.0, january 2004\b",
    "apache-2": r"\blicensed under the apache license,? (?:(?:version |v\.? ?)?2(?:\.0)?)\b",
    "apache-use": r"\byou may not use this file except in compliance with the license\b",
    "apache-copy": r"\byou may obtain a copy of the license at\b",
    "as-is-basis": r"\bdistributed on an as is basis\b",
    "apache-see": r"\bsee the license for the specific language governing permissions\b",
    "lgpl-redistribute": r"\bis free software\b.{0,160}\bgnu (?:lesser|library) general public license as published by\b",
    "agpl-redistribute": r"\bis free software\b.{0,160}\bgnu affero general public license as published by\b",
    "gpl-redistribute": r"\bis free software\b.{0,160}\bgnu general public license as published by\b",
    "lgpl-copy": r"\byou should have received a copy of the gnu (?:lesser|library) general public license\b",
    "agpl-copy": r"\byou should have received a copy of the gnu affero general public license\b",
    "gpl-copy": r"\byou should have received a copy of the gnu general public license\b",
    "lgpl-3": r"\bgnu (?:lesser|library) general public license,? (?:version |v\.? ?)3(?!\.?\d)",
    "lgpl-2.1": r"\bgnu (?:lesser|library) general public license,? (?:version |v\.? ?)2(?:\.1)?\b",
    "agpl-3": r"\bgnu affero general public license,? (?:version |v\.? ?)3\b",
    "gpl-title-2": r"\bgnu general public license version 2, june 1991\b",
    "gpl-title-3": r"\bgnu general public license version 3, 29 june 2007\b",
    "gpl-2": r"\blicensed under the (?:terms of the )?gnu general public license,? (?:version |v\.? ?)2\b",
    "gpl-3": r"\blicensed under the (?:terms of the )?gnu general public license,? (?:version |v\.? ?)3\b",
    "gpl-2-only": r"\bgnu general public license,? version 2(?: only)?,? as published by\b",
    "or-later-2.1": r"\beither version 2\.1(?: of the license)?,? or (?:\(at your option\) )?any later version\b",
    "or-later-2": r"\beither version 2(?:\.0)?(?: of the license)?,? or (?:\(at your option\) )?any later version\b",
    "or-later-3": r"\beither version 3(?:\.0)?(?: of the license)?,? or (?:\(at your option\) )?any later version\b",
    "gpl-verbatim": r"\bpermitted to copy and distribute verbatim copies of this license document\b",
    "gpl-hope": r"\bdistributed in the hope that it will be useful\b",
    "gpl-warranty": r"\bwithout even the implied warranty of merchantability or fitness for a particular purpose\b",
    "gpl-details": r"\bsee the gnu (?:lesser |library |affero )?general public license for more details\b",
    "gpl-write": r"\bif not, (?:write to the free software foundation|see:? \(?(?:https?:)? ?www\.gnu\.org)",
    "mit-released": r"\b(?:released|licensed|distributed|available) under the (?:terms of the )?mit license\b",
    "mit-permission": r"\bpermission is hereby granted, free of charge, to any person obtaining a copy\b",
    "mit-notice": r"\bthe above copyright notice and this permission notice (?:\([^)]{0,60}\) )?shall be included\b",
    "isc-permission": r"\bpermission to use, copy, modify,? and(?: ?or)? distribute this software for any purpose\b",
    "bsd-licensed": r"\b(?:released|licensed|distributed|available) under the (?:[23]-clause |new |simplified )?bsd license\b",
    "bsd-redistribution": r"\bredistribution and use in source and binary forms\b",
    "bsd-source": r"\bredistributions of source code must retain the above copyright notice\b",
    "bsd-binary": r"\bredistributions in binary form must reproduce the above copyright notice\b",
    "bsd-advertising": r"\badvertising materials mentioning features or use of this software must display\b",
    "bsd-endorse": r"\bmay be used to endorse or promote products\b",
    "warranty-as-is": r"\b(?:this|the) software is provided .{0,120}?\bas is\b",
    "no-liability": r"\bin no event shall\b.{0,160}?\bbe liable\b",
    "mpl-2": r"\bmozilla public license,? (?:v\. ?|version )2(?:\.0)?\b",
    "cc0": r"\bcc0 1\.0\b|\bcreative commons zero\b",
    "cc-by-nc-4": r"\blicensed under (?:a |the )?(?:cc by-nc 4\.0|creative commons attribution-noncommercial 4\.0)\b",
    "cc-by-sa-4": r"\blicensed under (?:a |the )?(?:cc by-sa 4\.0|creative commons attribution-sharealike 4\.0)\b",
    "cc-by-4": r"\blicensed under (?:a |the )?(?:cc by 4\.0|creative commons attribution 4\.0)\b",
    "public-domain": r"\breleased into the public domain\b",
    "all-rights": r"\ball rights reserved\b",
}
_APACHE = ("apache-use?", "apache-copy?", "as-is-basis?", "apache-see?")
_GNU = ("gpl-hope?", "gpl-warranty?", "gpl-details?")
_END = ("warranty-as-is?", "no-liability?")
# The rules in order; the first that fits at a place wins.  "?": need not be there.
RULES = (
    ("Apache-2.0", ("apache-title",)),
    ("Apache-2.0", ("apache-2", *_APACHE)),
    *((f"{licence}-{version}-or-later", (f"{kind}-redistribute", f"or-later-{number}", *_GNU, f"{kind}-copy?", "gpl-write?"))
      for licence, kind, version, number in (
          ("GPL", "gpl", "2.0", "2"), ("GPL", "gpl", "3.0", "3"), ("AGPL", "agpl", "3.0", "3"),
          ("LGPL", "lgpl", "2.0", "2"), ("LGPL", "lgpl", "2.1", "2.1"), ("LGPL", "lgpl", "3.0", "3"))),
    *((f"{kind.upper()}-or-later", (f"{kind}-redistribute", *_GNU, f"{kind}-copy?", "gpl-write?")) for kind in ("gpl", "lgpl", "agpl")),
    ("LGPL-3.0", ("lgpl-3", "gpl-verbatim?")),
    ("LGPL-2.1", ("lgpl-2.1", "gpl-verbatim?")),
    ("AGPL-3.0", ("agpl-3", "gpl-verbatim?")),
    ("GPL-2.0", ("gpl-title-2", "gpl-verbatim?")),
    ("GPL-3.0", ("gpl-title-3", "gpl-verbatim?")),
    ("GPL-2.0-or-later", ("gpl-2", "or-later-2", *_GNU, "gpl-copy?", "gpl-write?")),
    ("GPL-3.0-or-later", ("gpl-3", "or-later-3", *_GNU, "gpl-copy?", "gpl-write?")),
    ("GPL-2.0", ("gpl-2", *_GNU, "gpl-copy?", "gpl-write?")),
    ("GPL-3.0", ("gpl-3", *_GNU, "gpl-copy?", "gpl-write?")),
    ("GPL-2.0", ("gpl-2-only", *_GNU, "gpl-copy?", "gpl-write?")),
    ("MIT", ("mit-permission", "mit-notice?", *_END)),
    ("MIT", ("mit-released",)),
    ("ISC", ("isc-permission", *_END)),
    ("BSD-4-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-endorse?", *_END)),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse", *_END)),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", *_END)),
    ("BSD", ("bsd-redistribution", "bsd-source?", *_END)),
    ("BSD", ("bsd-licensed",)),
    ("MPL-2.0", ("mpl-2",)),
    ("CC0-1.0", ("cc0",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("public-domain", ("public-domain",)),
    ("all-rights-reserved", ("all-rights",)),
)
# A text with none of these holds no known sentence.  Single words, which no line break parts.
ANCHORS = ("licen", "permi", "redistribution", "endorse", "software", "domain", "reserved", "distributed", "liable", "warranty",
           "cc0", "commons", "version", "advertising")

_LINE = re.compile(r"\r\n?|\n")
_COMMENT = re.compile(r"^\s*(?:(?://+|/\*+|\*+/?|#+|--+|;+|<!--+|%+|>+|\|+|(?:dnl|rem)(?=\s))\s*)*|\s*(?:\*+/|--+>|\*+|#+|--+|//+|\|+)?\s*$", re.I)
_ITEM = re.compile(r"\(?(?:\d{1,2}|[a-z]|[ivx]{1,4})[.)]\s+|[-+•]\s+", re.I)
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_SIGN = re.compile(r"[\"'`“”‘’*#/\\<>|]+(?!-)")
_SPDX = re.compile(r"spdx-licen[sc]e-identifier:", re.I)
_SPDX_TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9](?:[A-Za-z0-9.:-]*[A-Za-z0-9])?\+?)")
_PATTERNS = tuple((name, re.compile(pattern)) for name, pattern in SENTENCES.items())


def sentences(text: str) -> list[str]:
    """The sentences of a text, without comment signs and list numbers.

    Lines are joined; a sentence ends at a full stop (or ! or ?) before white space, at a blank
    line (also one of comment signs only), before a list item and around an SPDX line.
    """
    out, part = [], []

    def close():
        if part:
            out.extend(_SENTENCE.split(" ".join(part)))
            part.clear()

    for line in _LINE.split(text):
        line = _COMMENT.sub("", line)
        if not line:
            close()
        elif _SPDX.search(line):
            close()
            out.append(line)
        else:
            # a number that ends the sentence of the line before ("version / 3. ...") is no list number
            if (item := _ITEM.match(line)) and (not part or part[-1][-1] in ".;:!?," or part[-1].lower().endswith((" and", " or"))):
                close()
                line = line[item.end():] or line
            part.append(line)
    close()
    return out


def normalise(sentence: str) -> str:
    """Lower case, one spelling of licence, no quotes or comment signs, single spaces."""
    return " ".join(_SIGN.sub(" ", sentence.lower().replace("licence", "license").replace("licensor", "license holder")).split())


def spdx_expression(text: str) -> str | None:
    """The longest SPDX expression at the start of ``text``, in lower case: identifiers, AND, OR,
    WITH and parentheses.  Of an expression that is not closed, the first identifier."""
    tokens, at, depth, operand, whole = [], 0, 0, False, 0
    while m := _SPDX_TOKEN.match(text, at):
        token, at = m[1], m.end()
        if operand:
            if token == ")" and depth:
                depth -= 1
            elif token in ("AND", "OR", "WITH"):
                operand = False
            else:
                break
        elif token == "(":
            depth += 1
        elif token in (")", "AND", "OR", "WITH"):
            break
        else:
            operand = True
        tokens.append(token.lower())
        if operand and not depth:
            whole = len(tokens)
    if not whole:
        return next((t for t in tokens if t != "("), None)
    return " ".join(tokens[:whole]).replace("( ", "(").replace(" )", ")")


def identify(sentence: str) -> list[str]:
    """Identifiers of the known licence sentences in a sentence, in their order; an SPDX line carries its licence."""
    found = [f"spdx:{e}" for m in _SPDX.finditer(sentence) if (e := spdx_expression(sentence[m.end():]))]
    clean = normalise(sentence)
    if not any(a in clean for a in ANCHORS):
        return found
    spans: list[tuple[int, int, str]] = []
    for name, pattern in _PATTERNS:
        spans += [(a, b, name) for a, b in (m.span() for m in pattern.finditer(clean)) if all(b <= c or d <= a for c, d, _ in spans)]
    return found + [name for name, _ in groupby(name for _, _, name in sorted(spans))]


def _fit(known: list[tuple[int, str]], at: int, wanted: tuple[str, ...], max_gap: int) -> int:
    """Where a rule that begins at ``at`` ends; ``at`` if it does not fit."""
    end = at
    for name in wanted:
        if end < len(known) and known[end][1] == name.rstrip("?") and (end == at or known[end][0] - known[end - 1][0] <= max_gap + 1):
            end += 1
        elif not name.endswith("?"):
            return at
    return end


def scan(text: str, max_gap: int = 2) -> list[tuple[str, int, int, list[str]]]:
    """(licence, first sentence, last sentence, identifiers) of each match, in text order.

    Up to ``max_gap`` unknown sentences may stand between two of a rule.  Known sentences that
    no rule uses are reported as "unclassified".
    """
    lower = text.lower()
    if not any(a in lower for a in ANCHORS):
        return []
    known = [(i, name) for i, s in enumerate(sentences(text)) for name in identify(s)]
    out, at = [], 0
    while at < len(known):
        first, name = known[at]
        end = at + 1
        licence = name[5:] if name.startswith("spdx:") else "unclassified"
        for rule, wanted in RULES:
            if (fits := _fit(known, at, wanted, max_gap)) > at:
                licence, end = rule, fits
                break
        out.append((licence, first, known[end - 1][0], [n for _, n in known[at:end]]))
        at = end
    return out


def license_matches(docs: DataFrame, max_gap: int = 2) -> DataFrame:
    """One row per match: ``doc_id``, ``license``, ``first_sentence`` and ``last_sentence`` (numbers
    from 0 in the document, as ``sentences`` cuts it), ``sentence_ids`` (comma-joined identifiers).

    Null, empty and licence-free texts give no rows; null doc_ids and repeated rows are scanned
    each; an empty table gives no rows; other columns are ignored.  Documents never move.
    """
    def run(batches):
        for batch in parts(batches):
            rows = [(d, licence, a, b, ",".join(ids)) for d, t in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True)
                    for licence, a, b, ids in scan(t, max_gap)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["doc_id", "license", "first_sentence", "last_sentence", "sentence_ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, license string, first_sentence long, last_sentence long, sentence_ids string")
