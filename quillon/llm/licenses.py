"""Licence scans by canonical digest.

A text, or a line of it, is brought to a canonical form: lower case, copyright
lines and punctuation gone, equivalent spellings made one, white space single.
The SHA-256 of the form is joined with the digests of known licences.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.text import let
from quillon.session import materialise

# Spellings that count as equal, as in the public guidelines for matching licence texts.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licenced": "licensed",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}

# Parts that several known licence texts share.
_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; "
    "OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.\n"
)
_BSD3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission.\n"
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
    "the following conditions:\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
    "above copyright notice and this permission notice appear in all copies.\n"
)
_ISC_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
# Known licences, each with the texts that stand for it.
KNOWN = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"),
    "BSD-2-Clause": (_BSD + _AS_IS, "SPDX-License-Identifier: BSD-2-Clause"),
    "BSD-3-Clause": (_BSD + _BSD3 + _AS_IS, "Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only"),
    "ISC": (_ISC + _ISC_AS_IS, "SPDX-License-Identifier: ISC"),
    "MIT": (_MIT, "MIT License\n" + _MIT, "Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"),
}
# SHA-256 of the canonical forms of full licence texts, as Debian ships them; a second one is of the text up to "END OF
# TERMS AND CONDITIONS", without its appendix.
FULL_TEXTS = {
    "Apache-2.0": ("405f3e81bce50e043ece9c20a3c65de9dc5ccd2e86d02b355b633c70a2d343da", "1469ca1ff6421801473eb2a0a564a724672d5c61b72ba35bf9f536ee3d6daf2a",),
    "Artistic-1.0-Perl": ("08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702",),
    "BSD-3-Clause": ("21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651",),
    "CC0-1.0": ("96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",),
    "GFDL-1.2": ("5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71",),
    "GFDL-1.3": ("93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6",),
    "GPL-1.0": ("9e12a40a9b22c45d116f19e1746b08ea0b853519de3e03ceb780f2a36d5f388c", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc",),
    "GPL-2.0": ("efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34",),
    "GPL-3.0": ("5a03c45024821019e59bbbf8d5bd13f8395e4e13204f3e1cf7fb58b2422ec219", "ad4a8c0f86b40eeaec03087f95684ff7965ffea480d1a58d4d7d9cb5ea929725",),
    "LGPL-2.0": ("289c8b47fa0ec7e5f22cd33d32feaa06f015b0f2fdb9ad916979b1011ca8c015", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260",),
    "LGPL-2.1": ("5ddd6039d3b090c51328879800301dd19b1ad99e14d00f3c6f221ab45a32db57", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4",),
    "LGPL-3.0": ("aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",),
    "MPL-1.1": ("1cfb6cca26abe2169c9c61164807107b2d4a0b64955a2cf2de46fad3483acda1",),
    "MPL-2.0": ("95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9",),
}
#: Every known canonical form has one of these; a text without any can't be one and is not brought to its form.
MARKS = r"licen|permi"

COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright\b(?!\s+(?:holder|owner|notice|law))|©|\(c\))[^\n]*$"
ALL_RIGHTS = r"all rights reserved\.?"
PUNCTUATION = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """The canonical form of a text."""
    t = F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " "), ALL_RIGHTS, " ")
    t = F.concat(F.lit(" "), F.regexp_replace(t, PUNCTUATION, " "), F.lit(" "))
    for other, usual in SPELLINGS.items():
        t = F.replace(t, F.lit(f" {other} "), F.lit(f" {usual} "))
    return F.btrim(t)


def canonical_text(text: str) -> str:
    """canonical() for the known texts, which are ASCII."""
    t = re.sub(ALL_RIGHTS, " ", re.sub(COPYRIGHT_LINE.replace(r"\p{L}\p{N}", "a-z0-9"), " ", text.lower()))
    t = " " + re.sub("[^a-z0-9]+", " ", t) + " "
    for other, usual in SPELLINGS.items():
        t = t.replace(f" {other} ", f" {usual} ")
    return t.strip()


def known_rows() -> list[tuple[str, str]]:
    """(digest, license) for each known text; a fixed and small number."""
    rows = {(hashlib.sha256(canonical_text(t).encode()).hexdigest(), name) for name, texts in KNOWN.items() for t in texts}
    return sorted(rows | {(digest, name) for name, digests in FULL_TEXTS.items() for digest in digests})


def known_digests(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(known_rows(), "digest string, license string")


def scan(docs: DataFrame) -> DataFrame:
    """For each row of docs: the licence that its whole text is, and those that its lines are.

    docs needs doc_id and text; other columns are ignored. Returns doc_id,
    digest (of the whole text's canonical form; null where the text has none of
    MARKS), license (null unless the whole text is a known one), line_licenses
    (names of the known one-line texts among its lines, sorted, joined by
    commas; empty if none) and n_license_lines.

    Null and empty texts have no digest and no licence. Every row gives a row of
    its own, those that repeat a doc_id or have none too. An empty table gives no
    rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = docs.select("doc_id", F.when(F.rlike(F.lower(text), F.lit(MARKS)), text).alias("_t"))
    hashed = marked.select("doc_id", F.when(F.col("_t").isNotNull(), F.sha2(canonical(F.col("_t")), 256)).alias("digest"), "_t")
    own_lines = F.filter(F.split("_t", r"\n", -1), lambda x: F.rlike(F.lower(x), F.lit(MARKS)))
    lines = F.transform(own_lines, lambda x: let(x, lambda y: F.sha2(canonical(y), 256)))
    whole = F.filter(F.array(F.struct(F.col("digest").alias("h"), F.lit(True).alias("whole"))), lambda x: x["h"].isNotNull())
    parts = F.coalesce(F.transform(lines, lambda h: F.struct(h.alias("h"), F.lit(False).alias("whole"))), F.array().cast("array<struct<h:string,whole:boolean>>"))
    units = materialise(hashed.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "digest", F.concat(whole, parts).alias("units")))

    known = known_digests(docs.sparkSession).withColumnRenamed("digest", "h")
    hits = units.select("_row", "doc_id", F.explode("units").alias("u")).select("_row", "doc_id", "u.h", "u.whole").join(F.broadcast(known), "h").select("_row", "doc_id", "license", "whole")
    rows = units.select("_row", "doc_id", "digest", F.lit(None).cast("string").alias("license"), F.lit(None).cast("boolean").alias("whole"))
    both = rows.unionByName(hits.select("_row", "doc_id", F.lit(None).cast("string").alias("digest"), "license", "whole"))
    return both.groupBy("_row", "doc_id").agg(
        F.max("digest").alias("digest"),
        F.max(F.when(F.col("whole"), F.col("license"))).alias("license"),
        F.array_join(F.sort_array(F.collect_set(F.when(~F.col("whole"), F.col("license")))), ",").alias("line_licenses"),
        F.count(F.when(~F.col("whole"), F.lit(1))).alias("n_license_lines"),
    ).drop("_row")
