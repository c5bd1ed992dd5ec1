"""Licence scan: digests of canonical texts joined to those of known licences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as one, replaced in this order.
SPELLINGS = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("copy right", "copyright"),
    ("organisation", "organization"),
    ("authoris", "authoriz"),
    ("recognis", "recogniz"),
    ("favour", "favor"),
    ("behaviour", "behavior"),
    ("wilful", "willful"),
    ("fulfilment", "fulfillment"),
    ("judgement", "judgment"),
    ("acknowledgement", "acknowledgment"),
    ("merchantibility", "merchantability"),
    ("per cent", "percent"),
    ("https", "http"),
    ("copyright owner", "copyright holder"),
)

#: A line that names a holder or year, which differs between copies of one licence.
COPYRIGHT_LINE = (
    r"^[^\p{L}\p{N}(©\n]*"
    r"(copyright[^\p{L}\p{N}\n]*(\(c\)|©|[0-9]{4}|by )|\(c\) *(copyright|[0-9]{4})|©).*$"
    r"|^[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*$"
)
#: A text without any of these has no such line.
COPYRIGHT_SIGNS = ("copyright", "(c)", "©", "all rights reserved")
NOT_WORD = r"[^\p{L}\p{N}\n]+"

# Known licence texts and notices.
KNOWN = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.

In jurisdictions that recognize copyright laws, the author or authors
of this software dedicate any and all copyright interest in the
software to the public domain. We make this dedication for the benefit
of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of
relinquishment in perpetuity of all present and future rights to this
software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR
OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
)

# Canonical titles, which stand before a licence or do not.
TITLES = (
    "mit license", "the mit license", "the mit license mit", "mit license mit", "expat license",
    "isc license", "the isc license", "isc license isc", "bsd zero clause license",
    "zero clause bsd license", "bsd 2 clause license", "the 2 clause bsd license",
    "simplified bsd license", "bsd 3 clause license", "the 3 clause bsd license",
    "new bsd license", "zlib license", "the zlib license", "the unlicense", "unlicense",
    "apache license", "version 2 0 january 2004", "apache license version 2 0",
    "apache license version 2 0 january 2004", "http www apache org licenses",
    "http www apache org licenses license 2 0", "gnu general public license",
    "version 1 february 1989", "version 2 june 1991", "version 3 29 june 2007",
    "gnu library general public license", "gnu lesser general public license",
    "version 2 1 february 1999", "gnu free documentation license", "version 1 2 november 2002",
    "version 1 3 3 november 2008", "mozilla public license", "mozilla public license version 2 0",
    "version 2 0", "version 1 1", "creative commons legal code", "cc0 1 0 universal",
    "the artistic license", "license",
)
LEADING_TITLES = f"^(?:(?:{'|'.join(sorted(TITLES, key=len, reverse=True))}) )+"

# Digests of longer canonical texts, with and without what follows their terms.
WHOLE = (
    ("Apache-2.0", "667b62a169edae7212be3c581edf5d6a1fa86c882eeef29e48612c852970f012"),
    ("Apache-2.0", "fb388936c12fba660a278043424b3f9a17c6b2e536674e390813ac3d06e7e73a"),
    ("Apache-2.0", "d7dd8e5c661e35d656a43688fc21624b0ba52216e4c419c747129bf83780d165"),
    ("Artistic-1.0-Perl", "09298ea5f55a44867296b42e98842579815a99e2b295c0aa24cf234134c9ebeb"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("CC0-1.0", "e3ba2aff64372f535373996fe68b166f9e97dc1ead5b471981213ebb8f310ad6"),
    ("GFDL-1.2", "2ac25285928a9ce6a8bde0e68e6d8ed774475113822c19df30f2474f15b171c0"),
    ("GFDL-1.2", "33e7b0c926b6b183f54237ad056a663d10fdbb688e1b34a2c0b2d2167ef7b2ac"),
    ("GFDL-1.3", "be68d33be24e4896ba28149c4f384a1bb29f6220b748d8ae6a580d56b0f62445"),
    ("GFDL-1.3", "fc6fcfc8a09b787d46f5061823461cd688e3982c62447eb912f448250a3f1238"),
    ("GPL-1.0", "4a0d740eb4453dafe0e6d04e2d2e4f04c7c85bc1fbef96bc056ea93e7c1c36bc"),
    ("GPL-1.0", "733356cadf8ca8b0ac2db2d593fb7c1a2b0528c7e891f8a911fdaeb64719fff5"),
    ("GPL-1.0", "422dc6ece1afadb367f2bcdbf6ac496f4c7ad5c973c45cdd09ae377ceb4c8a12"),
    ("GPL-2.0", "4767c85efb312bbe244abef9b752be38b44e810f05ed9bfae182caf068d13fd3"),
    ("GPL-2.0", "8fa94d3d812775805528fff117ea835ed908322b039e129b957550c1e107d3e2"),
    ("GPL-2.0", "a268f9c0a6d81f308a4286dac3b04b899da32e1ba02acf6eb78972ce623846e1"),
    ("GPL-3.0", "04a10e711844fe517f9ffba9481db6a825f2f268002c49184ecb8c942911bff3"),
    ("GPL-3.0", "4868f466a3292b095d887ce2ca00548d3969efb48c33f6aced9a20c59f578c19"),
    ("GPL-3.0", "ce818a0d5cb7a9a9261f63641713dbb4ca4750284738a6c3f546d86d81a541d2"),
    ("LGPL-2.0", "aa06ce7f6e464e73e65ec0efa0bc575ef5bb7059ae0137ab610c2e57b32ca95c"),
    ("LGPL-2.0", "81ecf332fc652bb79c23397a1431c72d1f39f01ffdcec61843942283b44f4688"),
    ("LGPL-2.0", "6e6982d8bb4468c5ce7a88e400f1540201513f39e8dd96e3607ee631b813c06f"),
    ("LGPL-2.1", "e94f6c31379c2076fae91e236d6000ea55d918637fc8f30749aa0fe22a265c7f"),
    ("LGPL-2.1", "98d365a8217633113a201b5777e4d26ae0eb1d88079c5e39838162abe1f18db4"),
    ("LGPL-2.1", "127c98b05c4e2851a27843fcf90984e5592c3841d8a6b7638dbcd00bcefe46dd"),
    ("LGPL-3.0", "13980739d6423be0921994d8ce3ce547437735b0e6733161f70b19c962f194b7"),
    ("MPL-1.1", "34386b9a926117ec1b973ef1b1ef8fba50be254811addc9f9659bcc5d5a096bf"),
    ("MPL-1.1", "8a55ff20466cda75ddfbce6bcd5a7304194719054dd2382740c6101e3e702530"),
    ("MPL-2.0", "61525901247b1a7c093fc10f73de8260d1d1a1a8b3bc78f417119ee4fcfb0979"),
    ("MPL-2.0", "8f27174c93cb7f68399e5e71af858fdef9c2151b9de96b0dd9bab40a165711b3"),
)


def core_text(lines: Column) -> Column:
    """Canonical lines as one text without the titles before it; the last one stays if it is all."""
    return F.regexp_replace(F.array_join(lines, " "), LEADING_TITLES, "")


def canonical_lines(text: Column) -> Column:
    """Canonical lines of a text, without empty ones and copyright lines.

    Words in lower case and one spelling, one blank apart. A text is treated as a
    whole before it is split, which is cheaper than line by line.
    """
    lower = F.lower(F.coalesce(text, F.lit("")))
    signs = [lower.contains(sign) for sign in COPYRIGHT_SIGNS]
    # m: lines begin and end anywhere; d: only at a line feed.
    cut = F.regexp_replace(lower, f"(?md){COPYRIGHT_LINE}", "")
    words = F.regexp_replace(F.when(reduce(or_, signs), cut).otherwise(lower), NOT_WORD, " ")
    for old, new in SPELLINGS:
        words = F.replace(words, F.lit(old), F.lit(new))
    return F.filter(F.transform(F.split(words, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def digest(words: Column) -> Column:
    return F.sha2(words, 256)


def known_digests(
    spark: SparkSession,
    known: Sequence[tuple[str, str]] | DataFrame = KNOWN,
    more: Sequence[tuple[str, str]] = WHOLE,
) -> DataFrame:
    """Distinct (known_digest, license_id); a digest of two licences names the smaller id.

    ``known`` is a sequence or a table (license_id, text), ``more`` holds digests that are
    ready. A text without words is no licence. Numbers of a list may be there or not.
    """
    if not isinstance(known, DataFrame):
        known = spark.createDataFrame(list(known), "license_id string, text string")
    forms = F.array("text", F.regexp_replace("text", r"(?m)^\s*\d+[.)]\s", ""))
    known = known.select("license_id", F.explode(forms).alias("text"))
    whole = core_text(canonical_lines(F.col("text")))
    digests = known.where(whole != "").select(digest(whole).alias("known_digest"), "license_id")
    ready = spark.createDataFrame(list(more), "license_id string, known_digest string")
    return (
        digests.unionByName(ready)
        .where("license_id is not null")
        .groupBy("known_digest")
        .agg(F.min("license_id").alias("license_id"))
    )


def scan_licences(
    docs: DataFrame,
    known: Sequence[tuple[str, str]] | DataFrame = KNOWN,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Which texts, and which of their lines, are a known licence as a whole.

    Returns one row for each distinct (doc_id, digest): doc_id, digest (of the
    canonical text without the titles before it), license_id (of the whole text, else null), notices (ids of
    lines that are known texts, sorted and comma-separated, else null) and
    n_lines (lines with words that are no copyright lines, over all copies).
    Null, empty and wordless texts have the digest of the empty text, no licence
    and n_lines 0. A text that is one line matches both ways. Equal rows fall
    together; a null doc_id is an id like others.

    Lines are counted and matched before the only shuffle, which carries one row
    for each document of a task. The digests of a sequence, which the caller holds
    in memory, are broadcast; those of a table only if Spark finds them under its
    threshold, else lines are shuffled by digest.
    """
    spark = docs.sparkSession
    digests = known_digests(spark, known)
    if not isinstance(known, DataFrame):
        digests = F.broadcast(digests)
    # Within the lambda the lines are a variable, made once however often they are used.
    digested = F.transform(
        F.array(canonical_lines(F.col(text))),
        lambda lines: F.struct(
            digest(core_text(lines)).alias("whole"), F.transform(lines, digest).alias("lines")
        ),
    )
    units = docs.select(F.col(doc_id).alias("doc_id"), F.inline(digested)).select(
        "doc_id", F.col("whole").alias("digest"), F.explode_outer("lines").alias("line_digest")
    )
    found = units.join(digests, F.col("line_digest") == F.col("known_digest"), "left")
    documents = found.groupBy("doc_id", "digest").agg(
        F.count("line_digest").alias("n_lines"), F.collect_set("license_id").alias("ids")
    )
    whole = digests.select(F.col("known_digest").alias("digest"), "license_id")
    return documents.join(whole, "digest", "left").select(
        "doc_id",
        "digest",
        "license_id",
        F.nullif(F.array_join(F.array_sort("ids"), ","), F.lit("")).alias("notices"),
        "n_lines",
    )
