"""Operator 9 (native): licence scans by sentence rules.

A text is cut into sentences, each normalised to lower-case letters and digits and mapped to the
identifier of a known licence sentence; the sequence of identifiers is matched against ordered
rules, longer and more specific ones first, and what a rule has matched is taken out of the sequence.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.llm.common import fresh

# Known licence sentences, normalised, by identifier. Standard wordings that run across a mark which ends a
# sentence stand here in the parts that the cut yields (apacheHead, apacheNotUse, gplTerms3, gplUseful and so on), and
# also whole, for texts without the mark.
SENTENCES = {
    "apacheHeader": "licensed under the apache license version 2 0",
    "apacheYou": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apacheHead": "licensed under the apache license version 2 0 the license",
    "apacheNotUse": "you may not use this file except in compliance with the license",
    "apacheCopy": "you may obtain a copy of the license at",
    "apacheUrl": "http www apache org licenses license 2 0",
    "apacheAsIs": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apacheSee": "see the license for the specific language governing permissions and limitations under the license",
    "mitRef": "released under the mit license",
    "mitRefUnder": "licensed under the mit license",
    "mitRefThis": "this project is licensed under the mit license",
    "mitTitle": "the mit license",
    "mitTitleShort": "mit license",
    "mitPerm": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mitNotice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mitAsIs": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "bsdRef2": "licensed under the bsd 2 clause license",
    "bsdRef3": "licensed under the bsd 3 clause license",
    "bsdPre": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsdSource": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsdBinary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "iscPerm": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "gpl3Work": "this work is licensed under the gnu general public license version 3",
    "gpl2Work": "this work is licensed under the gnu general public license version 2",
    "gpl3Ref": "licensed under the gnu general public license version 3",
    "gplFree3": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gplFree2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "lgplFree21": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "gplTerms3": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gplTerms2": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "lgplTerms21": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "gplTerms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "lgplTerms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "orLater3": "either version 3 of the license or at your option any later version",
    "orLater2": "either version 2 of the license or at your option any later version",
    "orLater21": "either version 2 1 of the license or at your option any later version",
    "gplHope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gplUseful": "this program is distributed in the hope that it will be useful but without any warranty",
    "lgplUseful": "this library is distributed in the hope that it will be useful but without any warranty",
    "gplImplied": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "gplSee": "see the gnu general public license for more details",
    "gplCopy": "you should have received a copy of the gnu general public license along with this program",
    "mplForm": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mplCopy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "ccByNc4": "licensed under cc by nc 4 0",
    "ccBy4": "licensed under cc by 4 0",
    "ccBySa4": "licensed under cc by sa 4 0",
    "ccByWork4": "this work is licensed under a creative commons attribution 4 0 international license",
    "ccBySaWork4": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "ccByNcWork4": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "allRights": "all rights reserved",
    "bsdName": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsdNameOf": "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission",
    "bsdAsIs": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsdDamages": "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services",
    "bsdDamagesOwner": "in no event shall the copyright owner or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services",
    "bsdTitle2": "bsd 2 clause license",
    "bsdTitle3": "bsd 3 clause license",
    "mitLiable": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "mitZeroPerm": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so",
    "iscTitle": "isc license",
    "iscAsIs": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "iscDamages": "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "zeroBsdPerm": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "zlibAsIs": "this software is provided as is without any express or implied warranty",
    "zlibPerm": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "zlibNotice": "this notice may not be removed or altered from any source distribution",
    "boostTitle": "boost software license version 1 0",
    "boostRef": "distributed under the boost software license version 1 0",
    "apacheTitle": "apache license",
    "apacheVersion": "version 2 0 january 2004",
    "apacheTerms": "terms and conditions for use reproduction and distribution",
    "apacheGrant": "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and distribute the work and such derivative works in source or object form",
    "gplTitle": "gnu general public license",
    "lgplTitle": "gnu lesser general public license",
    "agplTitle": "gnu affero general public license",
    "gplVersion3": "version 3 29 june 2007",
    "agplVersion3": "version 3 19 november 2007",
    "gplVersion2": "version 2 june 1991",
    "lgplVersion21": "version 2 1 february 1999",
    "gplVerbatim": "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed",
    "gplCopyleft3": "the gnu general public license is a free copyleft license for software and other kinds of works",
    "gplFreedom2": "the licenses for most software are designed to take away your freedom to share and change it",
    "agplCopyleft": "the gnu affero general public license is a free copyleft license for software and other kinds of works specifically designed to ensure cooperation with the community in the case of network server software",
    "agplTerms": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
    "agplTerms3": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgplTerms3": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agplRef3": "licensed under the gnu affero general public license version 3",
    "lgplRef3": "licensed under the gnu lesser general public license version 3",
    "gpl2Ref": "licensed under the gnu general public license version 2",
    "mplTitle": "mozilla public license version 2 0",
    "mplRef": "licensed under the mozilla public license version 2 0",
    "eplRef": "licensed under the eclipse public license 2 0",
    "eplMaterials": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "ccZero": "cc0 1 0 universal",
    "ccZeroWaived": "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    "wtfplTitle": "do what the fuck you want to public license",
    "unlicenseAnyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
}

# Licences whose SPDX tags are known; a tag's sentence and identifier follow from the name.
SPDX = (
    "MIT", "MIT-0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC", "Zlib", "BSL-1.0", "MPL-2.0", "EPL-2.0", "Unlicense", "WTFPL", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
    "CC-BY-NC-4.0", *(f"{name}-{kind}" for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for kind in ("only", "or-later")),
)


def _spdx_identifier(name: str) -> str:
    return "spdx" + "".join(c for c in name if c.isalnum())


SENTENCES |= {_spdx_identifier(name): "spdx license identifier " + " ".join(re.findall("[a-z0-9]+", name.lower())) for name in SPDX}

# Ordered rules, each a run of sentence identifiers and the licence it stands for.
RULES = [
    (("mitTitle", "mitPerm", "mitNotice", "mitAsIs", "mitLiable"), "MIT"),
    (("mitTitleShort", "mitPerm", "mitNotice", "mitAsIs", "mitLiable"), "MIT"),
    (("mitPerm", "mitNotice", "mitAsIs", "mitLiable"), "MIT"),
    (("mitTitle", "mitPerm", "mitNotice", "mitAsIs"), "MIT"),
    (("mitTitleShort", "mitPerm", "mitNotice", "mitAsIs"), "MIT"),
    (("mitPerm", "mitNotice", "mitAsIs"), "MIT"),
    (("mitPerm", "mitNotice"), "MIT"),
    (("apacheYou", "apacheCopy", "apacheUrl", "apacheAsIs", "apacheSee"), "Apache-2.0"),
    (("apacheYou", "apacheUrl", "apacheAsIs", "apacheSee"), "Apache-2.0"),
    (("apacheYou", "apacheCopy"), "Apache-2.0"),
    (("apacheHead", "apacheNotUse", "apacheCopy", "apacheUrl", "apacheAsIs", "apacheSee"), "Apache-2.0"),
    (("apacheHead", "apacheNotUse", "apacheUrl", "apacheAsIs", "apacheSee"), "Apache-2.0"),
    (("apacheHead", "apacheNotUse", "apacheCopy"), "Apache-2.0"),
    (("apacheHead", "apacheNotUse"), "Apache-2.0"),
    (("gplTerms3", "gplUseful", "gplImplied", "gplSee", "gplCopy"), "GPL-3.0-or-later"),
    (("gplTerms3", "gplUseful", "gplImplied", "gplSee"), "GPL-3.0-or-later"),
    (("gplTerms2", "gplUseful", "gplImplied", "gplSee", "gplCopy"), "GPL-2.0-or-later"),
    (("gplTerms2", "gplUseful", "gplImplied", "gplSee"), "GPL-2.0-or-later"),
    (("lgplTerms21", "lgplUseful", "gplImplied"), "LGPL-2.1-or-later"),
    (("gplTerms", "orLater3", "gplUseful", "gplImplied", "gplSee", "gplCopy"), "GPL-3.0-or-later"),
    (("gplTerms", "orLater3", "gplUseful", "gplImplied", "gplSee"), "GPL-3.0-or-later"),
    (("gplTerms", "orLater2", "gplUseful", "gplImplied", "gplSee", "gplCopy"), "GPL-2.0-or-later"),
    (("gplTerms", "orLater2", "gplUseful", "gplImplied", "gplSee"), "GPL-2.0-or-later"),
    (("lgplTerms", "orLater21", "lgplUseful", "gplImplied"), "LGPL-2.1-or-later"),
    (("gplFree3", "gplHope", "gplSee", "gplCopy"), "GPL-3.0-or-later"),
    (("gplFree3", "gplHope", "gplSee"), "GPL-3.0-or-later"),
    (("gplFree2", "gplHope", "gplSee", "gplCopy"), "GPL-2.0-or-later"),
    (("gplFree2", "gplHope", "gplSee"), "GPL-2.0-or-later"),
    (("bsdTitle3", "bsdPre", "bsdSource", "bsdBinary", "bsdName", "bsdAsIs"), "BSD-3-Clause"),
    (("bsdPre", "bsdSource", "bsdBinary", "bsdName", "bsdAsIs"), "BSD-3-Clause"),
    (("bsdPre", "bsdSource", "bsdBinary", "bsdNameOf"), "BSD-3-Clause"),
    (("bsdPre", "bsdSource", "bsdBinary", "bsdName"), "BSD-3-Clause"),
    (("bsdTitle2", "bsdPre", "bsdSource", "bsdBinary", "bsdAsIs"), "BSD-2-Clause"),
    (("bsdPre", "bsdSource", "bsdBinary", "bsdAsIs"), "BSD-2-Clause"),
    (("bsdPre", "bsdSource", "bsdBinary"), "BSD-2-Clause"),
    (("mplForm", "mplCopy"), "MPL-2.0"),
    (("gplFree3",), "GPL-3.0-or-later"),
    (("gplFree2",), "GPL-2.0-or-later"),
    (("lgplFree21",), "LGPL-2.1-or-later"),
    (("gplTerms", "orLater3"), "GPL-3.0-or-later"),
    (("gplTerms", "orLater2"), "GPL-2.0-or-later"),
    (("lgplTerms", "orLater21"), "LGPL-2.1-or-later"),
    (("gplTerms3",), "GPL-3.0-or-later"),
    (("gplTerms2",), "GPL-2.0-or-later"),
    (("lgplTerms21",), "LGPL-2.1-or-later"),
    (("gpl3Work",), "GPL-3.0"),
    (("gpl3Ref",), "GPL-3.0"),
    (("gpl2Work",), "GPL-2.0"),
    (("apacheHeader",), "Apache-2.0"),
    (("apacheYou",), "Apache-2.0"),
    (("apacheHead",), "Apache-2.0"),
    (("mitRef",), "MIT"),
    (("mitRefUnder",), "MIT"),
    (("mitRefThis",), "MIT"),
    (("mitPerm",), "MIT"),
    (("mitTitle",), "MIT"),
    (("mitTitleShort",), "MIT"),
    (("bsdRef2",), "BSD-2-Clause"),
    (("bsdRef3",), "BSD-3-Clause"),
    (("bsdTitle2",), "BSD-2-Clause"),
    (("bsdTitle3",), "BSD-3-Clause"),
    (("iscTitle", "iscPerm", "iscAsIs", "iscDamages"), "ISC"),
    (("iscPerm", "iscAsIs", "iscDamages"), "ISC"),
    (("iscPerm",), "ISC"),
    (("zeroBsdPerm", "iscAsIs", "iscDamages"), "0BSD"),
    (("zeroBsdPerm",), "0BSD"),
    (("mplForm",), "MPL-2.0"),
    (("ccByNc4",), "CC-BY-NC-4.0"),
    (("ccByNcWork4",), "CC-BY-NC-4.0"),
    (("ccBySa4",), "CC-BY-SA-4.0"),
    (("ccBySaWork4",), "CC-BY-SA-4.0"),
    (("ccBy4",), "CC-BY-4.0"),
    (("ccByWork4",), "CC-BY-4.0"),
    (("unlicense",), "Unlicense"),
    (("apacheTitle", "apacheVersion"), "Apache-2.0"),
    (("apacheGrant",), "Apache-2.0"),
    (("mitZeroPerm", "mitAsIs"), "MIT-0"),
    (("iscTitle",), "ISC"),
    (("iscAsIs", "iscDamages"), "ISC"),
    (("zlibAsIs", "zlibPerm", "zlibNotice"), "Zlib"),
    (("zlibPerm",), "Zlib"),
    (("boostTitle",), "BSL-1.0"),
    (("boostRef",), "BSL-1.0"),
    (("agplTitle", "agplVersion3"), "AGPL-3.0"),
    (("lgplTitle", "gplVersion3"), "LGPL-3.0"),
    (("lgplTitle", "lgplVersion21"), "LGPL-2.1"),
    (("gplTitle", "gplVersion3"), "GPL-3.0"),
    (("gplTitle", "gplVersion2"), "GPL-2.0"),
    (("agplCopyleft",), "AGPL-3.0"),
    (("gplCopyleft3",), "GPL-3.0"),
    (("gplFreedom2",), "GPL-2.0"),
    (("agplTerms3",), "AGPL-3.0-or-later"),
    (("agplTerms", "orLater3"), "AGPL-3.0-or-later"),
    (("lgplTerms3",), "LGPL-3.0-or-later"),
    (("lgplTerms", "orLater3"), "LGPL-3.0-or-later"),
    (("agplRef3",), "AGPL-3.0"),
    (("lgplRef3",), "LGPL-3.0"),
    (("gpl2Ref",), "GPL-2.0"),
    (("mplTitle",), "MPL-2.0"),
    (("mplRef",), "MPL-2.0"),
    (("eplRef",), "EPL-2.0"),
    (("eplMaterials",), "EPL-2.0"),
    (("ccZero",), "CC0-1.0"),
    (("ccZeroWaived",), "CC0-1.0"),
    (("wtfplTitle",), "WTFPL"),
    (("unlicenseAnyone",), "Unlicense"),
    *(((_spdx_identifier(name),), name) for name in SPDX),
    (("allRights",), "All-Rights-Reserved"),
]

# Words of which every known sentence has one, so that texts without any need no cutting, and those of
# them that mark a sentence as one about a licence.
ANCHORS = ("licens", "permission", "copyright", "redistribut", "warrant", "mpl", "apache", "public", "rights", "version", "cc0", "this software", "software is", "terms and conditions", "source distribution")
MARKS = ("licens", "copyright", "warrant")
#: What ends a sentence, what parts two words, and what a line break inside a paragraph looks like.
ENDS = "[.!?;:]+[ \\t\\r\\n]+|[\\r\\n]+"
ENDS_UNWRAPPED = "[.!?;:]+[ \\t\\r\\n]+|[\\r\\n][^a-z0-9\\r\\n]*[\\r\\n]+"
GAP = "[^a-z0-9]+"
#: Marks inside a known sentence whose rest alone names nothing ("mit", "2 0"): the white space after them is taken away, so
#: that they do not end it.
INSIDE = "(spdx-license-identifier:|mozilla[^a-z0-9]+public[^a-z0-9]+license[^a-z0-9]+v\\.)[ \\t]+"


def has_any(text: Column, words: tuple[str, ...]) -> Column:
    """Whether a lower-cased text or sentence holds one of the words."""
    found = F.lit(False)
    for word in words:
        found = found | F.contains(text, F.lit(word))
    return found


def _sentences(lowered: Column, ends: str) -> Column:
    cut = F.split(F.regexp_replace(lowered, ends, "\x01"), "\x01")
    return F.filter(F.transform(cut, lambda s: F.trim(F.regexp_replace(s, GAP, " "))), lambda s: s != "")


def _identifiers(sentences: Column) -> Column:
    known = F.create_map(*[F.lit(x) for i, s in SENTENCES.items() for x in (s, i)])
    return F.filter(F.transform(sentences, lambda s: F.try_element_at(known, s)), lambda i: i.isNotNull())


def scan(df: DataFrame, text: str = "text", into: str = "licence_scan") -> DataFrame:
    """Add `into`, a struct: licences (distinct, sorted), sentences (identifiers in order), unknown (sentences about a licence that are not known).

    Sentences are cut at line ends; where joining the lines of a paragraph finds more known ones, those count.
    Nulls: a null or empty text has no sentences and no licences. Other columns pass through; an existing column
    named `into` is replaced. Texts of any length are read whole, repeated rows each; an empty table stays empty.
    """
    df = df.drop(into)
    lowered, cut, wrapped, ids = (fresh(df, c) for c in ("_lowered", "_lines", "_unwrapped", "_ids"))
    none = F.array().cast("array<string>")
    out = df.withColumn(lowered, F.lower(F.coalesce(F.col(text), F.lit(""))))
    out = out.withColumn(lowered, F.when(has_any(F.col(lowered), ANCHORS), F.regexp_replace(F.col(lowered), INSIDE, "$1")))
    out = out.withColumn(cut, F.when(F.col(lowered).isNotNull(), _sentences(F.col(lowered), ENDS)).otherwise(none))
    out = out.withColumn(wrapped, F.when(F.col(lowered).isNotNull(), _sentences(F.col(lowered), ENDS_UNWRAPPED)).otherwise(none))
    out = out.withColumn(ids, F.struct(_identifiers(F.col(cut)).alias("a"), _identifiers(F.col(wrapped)).alias("b")))
    out = out.withColumn(ids, F.when(F.size(F.col(ids)["b"]) > F.size(F.col(ids)["a"]), F.col(ids)["b"]).otherwise(F.col(ids)["a"]))
    rules = F.array(*[F.struct(F.lit(f";{';'.join(seq)};").alias("run"), F.lit(name).alias("name")) for seq, name in RULES])
    sequence = F.concat(F.lit(";"), F.array_join(F.col(ids), ";"), F.lit(";"))
    start = F.struct(sequence.alias("left"), none.alias("found"))

    def apply(acc: Column, rule: Column) -> Column:
        hit = F.contains(acc["left"], rule["run"])
        left = F.when(hit, F.replace(acc["left"], rule["run"], F.lit(";"))).otherwise(acc["left"])
        return F.struct(left.alias("left"), F.when(hit, F.array_append(acc["found"], rule["name"])).otherwise(acc["found"]).alias("found"))

    found = F.when(F.size(F.col(ids)) > 0, F.aggregate(rules, start, apply)["found"]).otherwise(none)
    known = F.array(*[F.lit(s) for s in SENTENCES.values()])
    unknown = F.size(F.filter(F.col(cut), lambda s: has_any(s, MARKS) & ~F.array_contains(known, s)))
    fields = F.struct(F.array_sort(F.array_distinct(found)).alias("licences"), F.col(ids).alias("sentences"), unknown.cast("long").alias("unknown"))
    return out.withColumn(into, fields).select(*[F.col(f"`{c}`") for c in df.columns], into)
