"""Licence scans by sentence rules.

A text is cut into sentences, a sentence is normalised to lower-case words, and known licence sentences are
mapped to identifiers. The identifiers of a text, in order, are matched against ordered rules: at each place
the first rule whose sequence is there names a licence, and matching goes on behind it.

A text is cut at sentence ends (one of . ! ? ; : before white space), web addresses, bars and lines without a letter or
digit; what stands in front of the first letter or digit of a line (indents, bullets, comment marks) does not count. Line
ends are soft: a known sentence begins at a cut or a line start, ends at a cut or a line end, and may run on over
any line ends between, however it is wrapped. Where several known sentences begin, the longest counts.

Nulls: a null or empty text has no sentences and no licence (empty strings, 0, family ``none``). Repeated
sentences stand for themselves. Repeated rows are scanned each. An empty table gives no rows. Extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_text

# Sentences of published licences and notices, in normalised form.
SENTENCES = {
    "mit": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "apache": "licensed under the apache license version 2 0",
    "apache-grant": "licensed under the apache license version 2 0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "gpl2": "this work is licensed under the gnu general public license version 2",
    "gpl3": "this work is licensed under the gnu general public license version 3",
    "gpl-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl2-terms": "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl2-terms-later": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl3-terms-later": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "lgpl21-terms-later": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl3-terms-later": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-terms": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
    "agpl3-terms-later": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "later-2": "either version 2 of the license or at your option any later version",
    "later-21": "either version 2 1 of the license or at your option any later version",
    "later-3": "either version 3 of the license or at your option any later version",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by": "licensed under cc by 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc0": "this work has been dedicated to the public domain under a creative commons license",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-and": "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-redistribute": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    # The published notice says "v. 2.0", which is cut behind the v.
    "mpl": "this source code form is subject to the terms of the mozilla public license v",
    "boost": "distributed under the boost software license version 1 0",
    "reserved": "all rights reserved",
}
_GRANTS = [
    (["mit-grant", "mit-notice"], "MIT", "permissive"),
    (["apache-grant", "apache-comply", "apache-copy"], "Apache-2.0", "permissive"),
    (["gpl-terms", "later-2"], "GPL-2.0-or-later", "copyleft"),
    (["gpl-terms", "later-3"], "GPL-3.0-or-later", "copyleft"),
    (["lgpl-terms", "later-2"], "LGPL-2.0-or-later", "copyleft"),
    (["lgpl-terms", "later-21"], "LGPL-2.1-or-later", "copyleft"),
    (["lgpl-terms", "later-3"], "LGPL-3.0-or-later", "copyleft"),
    (["agpl-terms", "later-3"], "AGPL-3.0-or-later", "copyleft"),
    (["bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse"], "BSD-3-Clause", "permissive"),
    (["bsd-redistribute", "bsd-source", "bsd-binary"], "BSD-2-Clause", "permissive"),
    (["mit"], "MIT", "permissive"),
    (["mit-licensed"], "MIT", "permissive"),
    (["mit-grant"], "MIT", "permissive"),
    (["apache"], "Apache-2.0", "permissive"),
    (["apache-grant"], "Apache-2.0", "permissive"),
    (["gpl2"], "GPL-2.0", "copyleft"),
    (["gpl3"], "GPL-3.0", "copyleft"),
    (["gpl2-terms"], "GPL-2.0", "copyleft"),
    (["gpl2-terms-later"], "GPL-2.0-or-later", "copyleft"),
    (["gpl3-terms-later"], "GPL-3.0-or-later", "copyleft"),
    (["gpl-terms"], "GPL", "copyleft"),
    (["lgpl21-terms-later"], "LGPL-2.1-or-later", "copyleft"),
    (["lgpl3-terms-later"], "LGPL-3.0-or-later", "copyleft"),
    (["lgpl-terms"], "LGPL", "copyleft"),
    (["agpl3-terms-later"], "AGPL-3.0-or-later", "copyleft"),
    (["agpl-terms"], "AGPL", "copyleft"),
    (["cc-by-nc"], "CC-BY-NC-4.0", "non-commercial"),
    (["cc-by-sa"], "CC-BY-SA-4.0", "copyleft"),
    (["cc-by"], "CC-BY-4.0", "permissive"),
    (["cc0"], "CC0-1.0", "permissive"),
    (["unlicense"], "Unlicense", "permissive"),
    (["isc"], "ISC", "permissive"),
    (["isc-and"], "ISC", "permissive"),
    (["bsd-redistribute"], "BSD", "permissive"),
    (["mpl"], "MPL-2.0", "copyleft"),
    (["boost"], "BSL-1.0", "permissive"),
]
#: Rules in order: the identifiers in sequence, the licence, its family. A reservation of rights right before a grant
#: belongs to the copyright line above it and reserves nothing that is granted.
RULES = [*[(["reserved", *ids], *rest) for ids, *rest in _GRANTS], *_GRANTS, (["reserved"], "all rights reserved", "proprietary")]
#: Strictest first.
FAMILIES = ("proprietary", "non-commercial", "copyleft", "permissive")
#: Each known sentence has one of these words, so other texts need not be cut. Single words only: what stands
#: between the words of a sentence is not known before it is normalised.
HINT = r"(?i)licen[sc]e|permission|copies|copyright|warranty|reserved|redistribut|software"
#: (pattern, replacement with $1) in order, over lower-case text between two line ends. Then words stand between single
#: blanks, a soft line end is two line ends, and a cut is a bar between two line ends: so a sentence can
#: take one line end in front of it and one behind it.
NORMALISE = [
    (r"\n[^a-z0-9\n]+", "\n"),
    (r"https?://[^\x09-\x0D ]+", "|"),
    (r"[.!?;:]([\x09-\x0D ])", "|$1"),
    (r"[^a-z0-9\n|]+", " "),
    (r"\n[ \n]*\n", "|"),
    (r"[ \n]*\|[ \n|]*", "|"),
    (r" ?\n ?", "\n\n"),
    (r"\|", "\n|\n"),
]
#: A known sentence in normalised text, longest first.
SENTENCE = r"\n(" + "|".join(
    s.replace(" ", r"(?: |\n\n)") for s in sorted(SENTENCES.values(), key=len, reverse=True)) + r")\n"


def sequence_of(ids) -> str:
    """Identifiers as one string that rules can be searched in."""
    return "".join(f"<{i}>" for i in ids)


def _identifiers(text: Column) -> Column:
    known = F.create_map(*[F.lit(x) for name, sentence in SENTENCES.items() for x in (sentence, name)])
    cut = F.concat(F.lit("\n"), F.lower(text), F.lit("\n"))
    for pattern, replacement in NORMALISE:
        cut = F.regexp_replace(cut, pattern, replacement)
    return F.transform(F.regexp_extract_all(cut, F.lit(SENTENCE), F.lit(1)),
                       lambda x: F.element_at(known, F.replace(x, F.lit("\n\n"), F.lit(" "))))


def scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, licences, family, n_sentences, sentences: one row per document row."""
    pattern = "|".join(sequence_of(ids) for ids, _, _ in rules)
    named = lambda k: F.create_map(*[F.lit(x) for r in reversed(rules) for x in (sequence_of(r[0]), r[k])])
    none = F.array().cast("array<string>")
    hinted = F.col("text").rlike(HINT)
    found = (
        doc_text(docs)
        .withColumn("ids", F.when(hinted, _identifiers(F.col("text"))).otherwise(none))
        .select("doc_id", "ids", F.array_join(F.transform("ids", lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "").alias("sentences"))
        .withColumn("matched", F.regexp_extract_all("sentences", F.lit(pattern), F.lit(0)))
    )
    families = F.transform("matched", lambda m: F.element_at(named(2), m))
    strictest = F.coalesce(*[F.when(F.array_contains(families, f), F.lit(f)) for f in FAMILIES], F.lit("none"))
    licences = F.array_join(F.array_distinct(F.transform("matched", lambda m: F.element_at(named(1), m))), ", ")
    return found.select("doc_id", licences.alias("licences"), strictest.alias("family"),
                        F.size("ids").cast("bigint").alias("n_sentences"), "sentences")
