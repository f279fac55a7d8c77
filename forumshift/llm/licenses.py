"""Licence scans by canonical digest lookup, in DataFrame functions only.

A text is canonical when case, punctuation, white space, copyright lines and equivalent
spellings are gone.  Whole documents, and every line as a text of its own (notices are written
that way), are digested and hash-joined to the digests of the known licence texts.

The known texts are a small table of (licence, text), canonicalised by the same expression.  It
is broadcast only because its size is checked; a larger table is joined by shuffling.

Cases: null and empty texts match nothing; repeated rows each get their row; rows with one id
share their matches (null ids too); an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 10_000

# Spellings that count as equal, left becomes right, in this order.
SPELLINGS = [("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"),
             ("https ", "http "), ("copyright owner", "copyright holder"), ("version ", "v"), ("merchantibility", "merchantability")]
# Lines that name a copyright holder; they differ from copy to copy.
COPYRIGHT_LINE = r"^(copyright (c |© )?[0-9]{4}|copyright (c|©)( |$)|(c|©) [0-9]{4}|all rights reserved$)"

# Public licence notices and short licences.
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
]


def canonical(line: Column) -> Column:
    """One line: ASCII case folded, everything but letters, digits and non-ASCII made one space,
    spellings made equal; empty for a copyright line."""
    c = F.translate(line, string.ascii_uppercase, string.ascii_lowercase)
    c = F.trim(F.regexp_replace(c, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    for left, right in SPELLINGS:
        c = F.replace(c, F.lit(left), F.lit(right))
    return F.when(F.regexp_like(c, F.lit(COPYRIGHT_LINE)), F.lit("")).otherwise(c)


def _lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), canonical), lambda x: x != "")


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, whole_text (licence of which the entire text is a copy, or null), licenses
    (sorted, comma-joined: of the text or of any line), n_notices (lines that are one)."""
    spark = docs.sparkSession
    if known is None:
        known = spark.createDataFrame(KNOWN, "license string, text string")
    known = known.select("license", F.sha2(F.array_join(_lines(F.col("text")), " "), 256).alias("digest")).distinct()
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    texts = docs.select(F.col(id_col).alias("doc_id"), _lines(F.col(text_col)).alias("lines"))
    lines = F.transform("lines", lambda x: F.struct(F.lit(False).alias("whole"), F.sha2(x, 256).alias("digest")))
    entire = F.struct(F.lit(True).alias("whole"), F.sha2(F.array_join("lines", " "), 256).alias("digest"))
    units = texts.select("doc_id", F.explode(F.concat(F.array(entire), lines)).alias("unit"))
    hits = units.select("doc_id", "unit.*").join(known, "digest")
    hits = hits.groupBy("doc_id").agg(
        F.min(F.when(F.col("whole"), F.col("license"))).alias("whole_text"),
        F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"),
        F.sum(F.when(F.col("whole"), 0).otherwise(1)).cast("long").alias("n_notices"))
    ids = docs.select(F.col(id_col).alias("doc_id"))
    out = ids.join(hits.withColumnRenamed("doc_id", "d"), F.col("doc_id").eqNullSafe(F.col("d")), "left")
    return out.select("doc_id", "whole_text", F.coalesce("licenses", F.lit("")).alias("licenses"),
                      F.coalesce("n_notices", F.lit(0).cast("long")).alias("n_notices"))
