"""Licence scan by canonical digests.

An entire text is brought to a canonical form and looked up among the digests of known licences:
copyright statements go, case goes, white space and punctuation go, and spellings that count as the
same word are made one. A document is looked up as a whole, and so is each of its lines, since a
notice is a text of one line. The catalogue is checked to be small and broadcast; nothing is shuffled.

Null and empty texts, and units whose canonical form is empty, match nothing. A result row is one
match: line 0 is the whole text. Repeated documents match each. Null ids are kept.
"""
import re
from functools import reduce
from pathlib import Path

from pyspark.sql import functions as F

from .common import id_and_text

MAX_CATALOGUE = 20_000

# Notices and licence texts that are looked for, under their usual short names.
KNOWN = {
    "MIT-notice": ["Released under the MIT License."],
    "Apache-2.0-notice": ["Licensed under the Apache License, Version 2.0."],
    "GPL-3.0-notice": ["This work is licensed under the GNU General Public License, version 3."],
    "CC-BY-NC-4.0-notice": ["Licensed under CC BY-NC 4.0."],
    "MIT": ["""MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN
NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""],
    "ISC": ["""ISC License

Copyright <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all
copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE
LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING
FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""],
}

_CLAUSE_3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to "
             "endorse or promote products derived from this software without specific prior written "
             "permission.")


def _variants(text):
    """The text with and without its first paragraph (the title), and with and without its appendix."""
    whole = [text]
    if (end := re.search(r"END OF TERMS AND CONDITIONS", text)):
        whole += [text[:end.start()], text[:end.end()]]
    return [v for t in whole for v in (t, t.strip().partition("\n\n")[2])]


def full_texts():
    """Entire licences of the folder licence_texts, in their usual variants."""
    known = {f.stem: f.read_text("utf-8") for f in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}
    bsd = known["BSD-2-Clause"]
    known["BSD-3-Clause"] = bsd.replace("THIS SOFTWARE IS", f"{_CLAUSE_3}\n\nTHIS SOFTWARE IS", 1)
    texts = {name: _variants(text) for name, text in known.items()}
    for name in ("BSD-2-Clause", "BSD-3-Clause"):
        body = known[name][known[name].index("Redistribution and use"):]
        texts[name] += [body, f"All rights reserved.\n{body}"]
    for name in ("MIT", "ISC"):
        texts[name] = [v for t in KNOWN[name] for v in _variants(t)]
    return texts


# Spellings that count as the same, second becomes first, without spaces.
SPELLINGS = [
    ("license", "licence"), ("licensed", "licenced"), ("sublicense", "sub-license"),
    ("organization", "organisation"), ("acknowledgment", "acknowledgement"),
    ("noncommercial", "non-commercial"), ("percent", "per cent"),
    ("copyrightholder", "copyright owner"),
]


#: A copyright mark followed by (c), a year or a placeholder; the sign alone is enough.
STATEMENT = (r"(?md)^[ \t#*/;!-]*(?:©|copyright[ \t:]*(?:\(c\)|©|[0-9]{4}|[<\[{])"
             r"|\(c\)[ \t]*(?:copyright|[0-9]{4}|[<\[{]))[^\n]*")


#: White space, control characters and punctuation.
MARKS = r"[\x00-/:-@\[-`{-\x7f\p{P}\p{Z}\p{Cf}]+"


def canonical(text):
    """The canonical form of a text column."""
    lowered = F.lower(text)
    # Lines that are a copyright statement; (?d) lets lines end with a line feed only. Most texts
    # hold no such mark at all and are spared the search.
    marked = lowered.contains("copyright") | lowered.contains("(c)") | lowered.contains("©")
    kept = F.when(marked, F.regexp_replace(
        lowered, STATEMENT, "")).otherwise(lowered)
    spelt = F.replace(kept, F.lit("&"), F.lit("and"))
    bare = F.regexp_replace(spelt, MARKS, "")
    for one, other in [(_bare(a), _bare(b)) for a, b in SPELLINGS]:
        bare = F.replace(bare, F.lit(other), F.lit(one))
    return bare


def _bare(word):
    return "".join(c for c in word if c.isalnum())


def digest(text):
    """Digest of the canonical form, never null: a join then needs no filter that computes it again."""
    return F.coalesce(F.sha2(canonical(F.coalesce(text, F.lit(""))), 256), F.lit(""))


def catalogue(spark, known=None):
    """(digest, license) of the known texts, each digest once (the first name by order)."""
    if known is None:
        known = known_texts()
    names = [(name, text) for name, texts in known.items() for text in texts]
    if len(names) > MAX_CATALOGUE:
        raise ValueError(f"the catalogue may hold {MAX_CATALOGUE} texts, it has {len(names)}")
    rows = [F.struct(F.lit(n).alias("license"), F.lit(t).alias("text")) for n, t in names]
    return (spark.range(1).select(F.inline(F.array(*rows)))
            .where(canonical(F.col("text")) != "")
            .select(digest(F.col("text")).alias("digest"), "license").groupBy("digest").agg(F.min("license").alias("license")))


def scan(docs, known=None, id_col="doc_id", text_col="text"):
    """Matches (doc_id, line, license, digest) of whole texts (line 0) and of single lines."""
    rows = id_and_text(docs, id_col, text_col)
    whole = F.array(F.struct(F.lit(0).alias("line"), F.col("text").alias("unit")))
    lines = F.transform(F.split("text", "\n"), lambda unit, i: F.struct(
        (i + 1).cast("int").alias("line"), unit.alias("unit")))
    units = rows.select("doc_id", F.inline(F.concat(whole, lines)))
    table = F.broadcast(catalogue(docs.sparkSession, known))  # at most MAX_CATALOGUE rows
    return (units.select("doc_id", "line", digest(F.col("unit")).alias("digest"))
            .join(table, "digest").select("doc_id", "line", "license", "digest"))


def op7_licenses(spark, sf_dir):
    """Licence matches in all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def known_texts():
    """{short name: its texts} of the whole catalogue."""
    full = full_texts()
    return {name: KNOWN.get(name, []) + full.get(name, []) for name in {**KNOWN, **full}}


def _sql_form(column):
    # The other engine's patterns have no (?d): its lines end with a line feed only anyway.
    form = f"regexp_replace(lower({column}), '{STATEMENT.replace('(?md)', '(?m)')}', '', 'g')"
    form = f"replace({form}, '&', 'and')"
    form = f"regexp_replace({form}, '{MARKS}', '', 'g')"
    words = [(_bare(a), _bare(b)) for a, b in SPELLINGS]
    return reduce(lambda f, w: f"replace({f}, '{w[1]}', '{w[0]}')", words, form)


OP7_SQL = """
WITH known AS (
  SELECT min(license) AS license, sha256(form) AS digest
  FROM (SELECT license, {known_form} AS form FROM (VALUES {values}) k(license, text))
  WHERE form <> '' GROUP BY sha256(form)
), units AS (
  SELECT doc_id, 0 AS line, coalesce(text, '') AS unit FROM documents
  UNION ALL
  SELECT doc_id, unnest(range(1, len(parts) + 1))::INTEGER AS line, unnest(parts) AS unit
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), forms AS (
  SELECT doc_id, line, {unit_form} AS form FROM units
)
SELECT doc_id, line, license, digest
FROM (SELECT doc_id, line, sha256(form) AS digest FROM forms WHERE form <> '') JOIN known USING (digest)
""".format(known_form=_sql_form("text"), unit_form=_sql_form("unit"), values=", ".join(
    "('{}', '{}')".format(n, t.replace("'", "''")) for n, ts in known_texts().items() for t in ts))
