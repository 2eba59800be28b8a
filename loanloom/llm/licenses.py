"""License statements in texts, by ordered signature rules.

A rule is a hand-written regular expression over the lower-cased words of a text
joined by single spaces, with a label, a priority, a strength and keywords: words of
which every match contains one, and one must occur before the expression is tried. Of overlapping detections one that lies
within another of the same or a higher priority goes. The three base phrases
are found beside the rules on every text, by their words.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.text import WORD_BYTES, Words, steps

#: The base phrases and their labels.
BASE = {
    ("cc", "by"): "cc-by",
    ("general", "public", "license"): "gpl",
    ("all", "rights", "reserved"): "reserved",
}


@dataclass(frozen=True)
class Rule:
    """Higher ``priority`` first; ``strength`` (0 to 1) is how sure a match makes the label."""

    keywords: tuple[str, ...]
    pattern: str
    label: str
    priority: int
    strength: float


# One expression per line: label, keywords (one stands as a word in every match), expression. Words stand alone, versions are words of their own
# ("v2" or "2 0"), so that "GPL-2.0" reads "gpl 2 0".
_NOTICES = r"""
mit | permission | permission is hereby granted free of charge to any person obtaining a copy
mit | mit | (?:under|with) (?:the )?(?:terms of the )?mit(?: x11)? licen[cs]e
mit | mit | mit licen[cs]ed?
mit | expat | (?:the )?expat licen[cs]e
mit-0 | mit | mit no attribution
bsd | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd | bsd | (?:under|with) (?:the |a )?(?:modified |new |simplified |revised )?bsd(?: style)? licen[cs]e
bsd-2-clause | bsd | bsd 2 clause
bsd-2-clause | freebsd | freebsd licen[cs]e
bsd-2-clause | simplified | simplified bsd licen[cs]e
bsd-3-clause | bsd | bsd 3 clause
bsd-3-clause | neither | neither the name of (?:\w+ ){1,8}nor the names of its contributors may be used
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display
bsd-4-clause | bsd | bsd 4 clause
0bsd | bsd 0bsd | (?:zero clause bsd|bsd zero clause|0bsd)
isc | permission | permission to use copy modify and or distribute this software for any purpose with or without fee
isc | isc | isc licen[cs]e
apache-2.0 | apache | apache licen[cs]e(?: version)? v?2(?: 0)?
apache-2.0 | apache | (?:www )?apache org licenses license 2 0
apache-2.0 | apache | licensed under the apache licen[cs]e
apache-1.1 | apache | apache (?:software )?licen[cs]e(?: version)? v?1 1
apache-1.0 | apache | apache (?:software )?licen[cs]e(?: version)? v?1 0
gpl | gnu | gnu general public licen[cs]e
gpl | gpl | (?:under|with) (?:the )?(?:terms of the )?(?:gnu )?gpl
gpl | gplv1 gplv2 gplv3 | gplv[123]
gpl-1.0 | general | (?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 1
gpl-2.0 | general | (?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 2
gpl-3.0 | general | (?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 3
gpl-2.0 | gpl | (?:gnu )?gpl(?: version)? v?2(?: 0)?
gpl-3.0 | gpl | (?:gnu )?gpl(?: version)? v?3(?: 0)?
gpl | franklin | free software foundation inc (?:\d+ )?franklin st
gpl | temple | free software foundation inc (?:\d+ )?temple place
gpl | redistribute | this program is free software you can redistribute it and or modify
lgpl | lesser | (?:gnu )?lesser general public licen[cs]e
lgpl | library | (?:gnu )?library general public licen[cs]e
lgpl-2.0 | library | (?:gnu )?library general public licen[cs]e(?: as published by the free software foundation)? version 2
lgpl-2.1 | lesser | (?:gnu )?lesser general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 2 1
lgpl-3.0 | lesser | (?:gnu )?lesser general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 3
lgpl-2.1 | lgpl | (?:gnu )?lgpl(?: version)? v?2 1
lgpl-3.0 | lgpl | (?:gnu )?lgpl(?: version)? v?3
lgpl-2.1 | lgplv2 | lgplv2 1
lgpl-2.0 | lgplv2 | lgplv2(?: 0)?
lgpl-3.0 | lgplv3 | lgplv3(?: 0)?
lgpl | lgpl | (?:gnu )?lgpl
agpl | affero | (?:gnu )?affero general public licen[cs]e
agpl-3.0 | affero | (?:gnu )?affero general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 3
agpl-3.0 | agpl | (?:gnu )?agpl(?: version)? v?3
agpl-3.0 | agplv3 | agplv3(?: 0)?
agpl | agpl | (?:gnu )?agpl
gfdl | documentation | gnu free documentation licen[cs]e
mpl-2.0 | mozilla | mozilla public licen[cs]e(?: version)? v? ?2(?: 0)?
mpl-1.1 | mozilla | mozilla public licen[cs]e(?: version)? v? ?1 1
mpl-1.0 | mozilla | mozilla public licen[cs]e(?: version)? v? ?1 0
mpl | mozilla | mozilla public licen[cs]e
mpl-2.0 | mpl | mozilla org mpl 2 0
epl-1.0 | eclipse | eclipse public licen[cs]e(?: version)? v? ?1(?: 0)?
epl-2.0 | eclipse | eclipse public licen[cs]e(?: version)? v? ?2(?: 0)?
epl | eclipse | eclipse public licen[cs]e
edl | eclipse | eclipse distribution licen[cs]e
cddl | development | common development and distribution licen[cs]e(?: cddl)?
cpl | common | common public licen[cs]e
ipl | ibm | ibm public licen[cs]e
eupl | european | european union public licen[cs]e
cecill | cecill | cecill(?: [abc])? (?:free software )?licen[cs]e
artistic | artistic | (?:the )?(?:perl )?artistic licen[cs]e
artistic-2.0 | artistic | artistic licen[cs]e v? ?2(?: 0)?
zlib | provided | this software is provided as is without any express or implied warranty in no event will the authors
zlib | zlib | zlib(?: libpng)? licen[cs]e
libpng | libpng | libpng licen[cs]e
boost | boost | boost software licen[cs]e(?: version)?(?: 1 0)?
python | python | python software foundation licen[cs]e
php | php | php licen[cs]e(?: version)? 3 0[01]?
ruby | ruby | ruby licen[cs]e
openssl | openssl | openssl(?: ssleay)? licen[cs]e
curl | curl | curl licen[cs]e
postgresql | postgresql | postgresql licen[cs]e
ncsa | ncsa | (?:university of illinois )?(?:open source )?ncsa (?:open source )?licen[cs]e
w3c | w3c | w3c software (?:notice and )?licen[cs]e
unicode | unicode | unicode (?:inc )?licen[cs]e agreement
unlicense | unencumbered | free and unencumbered software released into the public domain
unlicense | unlicense | the unlicense
wtfpl | fuck | do what the fuck you want to public licen[cs]e
wtfpl | wtfpl | wtfpl
beerware | beer beerware | (?:beer ?ware|beer ware) licen[cs]e
sspl | server | server side public licen[cs]e
bsl-1.1 | business | business source licen[cs]e(?: 1 1)?
elastic-2.0 | elastic | elastic licen[cs]e(?: 2 0)?
commons-clause | clause | commons clause licen[cs]e condition
polyform | polyform | polyform (?:noncommercial|small business|strict|shield) licen[cs]e
openrail | openrail rail | (?:bigscience |creativeml )?open ?rail(?: m)?
odbl | open | open (?:data commons open )?database licen[cs]e
odc-by | commons | open data commons attribution licen[cs]e
pddl | dedication | public domain dedication and licen[cs]e
ofl | font | sil open font licen[cs]e(?: version)?(?: 1 1)?
ofl | ofl | ofl 1 1
free-art | art | free art licen[cs]e
ogl | government | open government licen[cs]e
cc0 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0 | zero | creative commons zero
cc0 | waived | (?:has|have) waived all copyright and related or neighboring rights
cc | creativecommons | creativecommons org licenses [a-z]+(?: [a-z]+)* \d 0
cc | creative | licensed under (?:a |the )?creative commons
public-domain | domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | domain | (?:this work|it) is in the public domain
proprietary | proprietary | proprietary and confidential
proprietary | unauthorized | unauthorized (?:copying|reproduction|use) of this (?:file|work|software)
proprietary | reproduced | no part of this (?:publication|book|work|document) may be reproduced
proprietary | written | without (?:the )?(?:prior|express) written (?:permission|consent)
reserved | alle | alle rechte vorbehalten
reserved | droits | tous droits r[ée]serv[ée]s
reserved | derechos | (?:todos los )?derechos reservados
reserved | rights | rights reserved
copyright | copyright | copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)*
copyright | copr | copr (?:19|20)\d\d
"""

# Creative Commons: every combination of elements, by name and by abbreviation.
_ELEMENTS = {
    "by": "attribution",
    "by sa": "attribution share ?alike",
    "by nd": "attribution no ?deriv(?:ative)?s?",
    "by nc": "attribution non ?commercial",
    "by nc sa": "attribution non ?commercial share ?alike",
    "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s?",
}
_CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

# SPDX tags: one rule per identifier, as words.
_SPDX = """
MIT, MIT-0, ISC, 0BSD, BSD-2-Clause, BSD-3-Clause, BSD-4-Clause, Apache-1.0, Apache-1.1, Apache-2.0, GPL-1.0, GPL-2.0,
GPL-3.0, LGPL-2.0, LGPL-2.1, LGPL-3.0, AGPL-1.0, AGPL-3.0, GFDL-1.1, GFDL-1.2, GFDL-1.3, MPL-1.0, MPL-1.1, MPL-2.0,
EPL-1.0, EPL-2.0, CDDL-1.0, CDDL-1.1, CPL-1.0, IPL-1.0, EUPL-1.1, EUPL-1.2, Artistic-1.0, Artistic-2.0, Zlib, Libpng,
BSL-1.0, PSF-2.0, Python-2.0, PHP-3.01, Ruby, OpenSSL, curl, PostgreSQL, NCSA, W3C, Unlicense, WTFPL, Beerware, SSPL-1.0,
BUSL-1.1, Elastic-2.0, ODbL-1.0, ODC-By-1.0, PDDL-1.0, OFL-1.0, OFL-1.1, CC0-1.0, AFL-3.0, APSL-2.0, OSL-3.0, MS-PL,
MS-RL, QPL-1.0, Vim, X11, NTP, HPND, UPL-1.0, TCL, Sleepycat, LPPL-1.3c, CAL-1.0, CPAL-1.0, RPL-1.5, SPL-1.0, ZPL-2.1
"""


def _rules() -> list[Rule]:
    """All rules, most specific first."""
    found = []
    for line in _NOTICES.strip().splitlines():
        label, keywords, pattern = (x.strip() for x in line.split("|", 2))
        versioned = any(c.isdigit() for c in label)
        found.append(Rule(tuple(keywords.split()), pattern, label, 3 if versioned else 2, 0.95 if versioned else 0.8))
    for short, name in _ELEMENTS.items():
        label = "cc-" + short.replace(" ", "-")
        for version in _CC_VERSIONS:
            full = f"{label}-{version.replace(' ', '.')}"
            found.append(Rule(("cc",), rf"cc {short} {version}", full, 4, 0.95))
            found.append(Rule(("creative",), rf"creative commons {name}(?: (?:unported|international|licen[cs]e))? {version}", full, 4, 0.95))
            found.append(Rule(("creativecommons",), rf"creativecommons org licenses {short} {version}", full, 4, 0.95))
        found.append(Rule(("cc",), rf"cc {short}", label, 3, 0.8))
        found.append(Rule(("creative",), rf"creative commons {name}", label, 3, 0.85))
    for name in _SPDX.replace("\n", " ").split(","):
        words = re.sub("[^a-z0-9]+", " ", name.strip().lower()).strip()
        found.append(Rule(("spdx",), rf"spdx license identifier {words}(?: only| or later)?", name.strip().lower(), 5, 1.0))
    return sorted(found, key=lambda r: (-r.priority, -len(r.pattern), r.pattern, r.label))


RULES = _rules()


@dataclass
class Scanner:
    """The rules by keyword, compiled once in a worker."""

    by_keyword: dict[bytes, list[tuple[Rule, re.Pattern[str]]]]

    @classmethod
    def of(cls, rules: list[Rule]) -> Scanner:
        found: dict[bytes, list[tuple[Rule, re.Pattern[str]]]] = {}
        for rule in rules:
            pattern = re.compile(rf"(?<!\S)(?:{rule.pattern})(?!\S)")
            for keyword in rule.keywords:
                found.setdefault(keyword.encode(), []).append((rule, pattern))
        return cls(found)

    def detect(self, text: str, keywords: set[bytes]) -> list[tuple[int, int, Rule]]:
        """The detections that stand, over words joined by spaces, in order."""
        spans = []
        for rule, pattern in {tried for keyword in keywords for tried in self.by_keyword[keyword]}:
            spans += [(m.start(), m.end(), rule) for m in pattern.finditer(text)]
        spans.sort(key=lambda s: (-s[2].priority, s[0] - s[1], s[0], s[2].label))
        # Priorities from the highest, longer spans first: a span that lies in a kept one goes.
        kept: list[tuple[int, int, Rule]] = []
        reach: list[tuple[int, int]] = []  # kept spans that lie in no other, by start
        for start, end, rule in spans:
            at = bisect.bisect_right(reach, (start, 1 << 62)) - 1
            if at >= 0 and reach[at][1] >= end:
                continue
            kept.append((start, end, rule))
            low = bisect.bisect_left(reach, (start, -1))
            high = low
            while high < len(reach) and reach[high][1] <= end:
                high += 1
            if low == 0 or reach[low - 1][1] < end:
                reach[low:high] = [(start, end)]
        return sorted(kept, key=lambda s: (s[0], s[1], s[2].label))


def _base(symbol: np.ndarray, ends: np.ndarray, vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of every base phrase, within texts that end at ``ends``."""
    number = {w: k for k, w in enumerate(vocabulary)}
    first, which = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for k, phrase in enumerate(BASE):
        n = len(phrase)
        if symbol.size < n:
            continue
        hit = np.ones(symbol.size - n + 1, dtype=bool)
        for j, word in enumerate(phrase):
            hit &= symbol[j : symbol.size - n + 1 + j] == number[word.encode()]
        at = np.flatnonzero(hit)
        at = at[at + n <= ends[np.searchsorted(ends, at, side="right")]]
        first.append(at)
        which.append(np.full(at.size, k))
    return np.concatenate(first), np.concatenate(which)


RESULT = {
    "n_words": "long",
    "n_base": "long",
    "first_word": "long",
    "last_word": "long",
    "base_labels": "array<string>",
    "detections": "array<struct<label: string, start: long, end: long, priority: int, strength: double>>",
}


def _scan(batches: Iterator[pa.RecordBatch], names: list[str], rules: list[Rule]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner.of(rules)
    vocabulary = sorted({w.encode() for phrase in BASE for w in phrase} | set(scanner.by_keyword))
    values = pa.array(vocabulary, pa.large_binary())
    is_keyword = np.array([w in scanner.by_keyword for w in vocabulary])
    base_labels = list(BASE.values())
    detection = pa.list_(
        pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("priority", pa.int32()), ("strength", pa.float64())])
    )
    for batch in steps(batches, "__text"):
        n = batch.num_rows
        words = Words(batch.column("__text"), WORD_BYTES)
        tokens = words.array()
        symbol = pc.fill_null(pc.index_in(tokens, value_set=values), -1).to_numpy().astype(np.int64)
        first, which = _base(symbol, words.bounds[1:], vocabulary)
        doc = np.searchsorted(words.bounds, first, side="right") - 1
        count = np.bincount(doc, minlength=n)
        low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
        np.minimum.at(low, doc, first)
        np.maximum.at(high, doc, first)
        absent = count == 0
        labels: list[set[str]] = [set() for _ in range(n)]
        for d, k in np.unique(np.stack([doc, which], axis=1), axis=0).tolist():
            labels[d].add(base_labels[k])
        keyed = np.flatnonzero((symbol >= 0) & is_keyword[symbol])
        owner = np.searchsorted(words.bounds, keyed, side="right") - 1
        gates: dict[int, set[bytes]] = {}
        for d, k in np.unique(np.stack([owner, symbol[keyed]], axis=1), axis=0).tolist():
            gates.setdefault(d, set()).add(vocabulary[k])
        found: list[list[dict]] = [[] for _ in range(n)]
        for d, keywords in gates.items():
            text = b" ".join(tokens[int(words.bounds[d]) : int(words.bounds[d + 1])].to_pylist()).decode("utf-8", "replace")
            place = None
            for start, end, rule in scanner.detect(text, keywords):
                place = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), dtype="<u4") == 32) if place is None else place
                a, b = int(np.searchsorted(place, start)), int(np.searchsorted(place, end)) + 1
                found[d].append({"label": rule.label, "start": a, "end": b, "priority": rule.priority, "strength": rule.strength})
        own = [
            pa.array(words.counts.astype(np.int64)),
            pa.array(count.astype(np.int64)),
            pa.array(low - words.bounds[:-1], mask=absent),
            pa.array(high - words.bounds[:-1], mask=absent),
            pa.array([sorted(x) for x in labels], pa.list_(pa.string())),
            pa.array(found, detection),
        ]
        rest = [c for c in batch.schema.names if c != "__text"]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + own, names=[*rest, *names])


def scan(docs: DataFrame, keep: list[str], prefix: str = "", rules: list[Rule] | None = None) -> DataFrame:
    """The columns ``keep`` of every document, with the base phrases and the rules' detections.

    ``n_words``; ``n_base``, the places of base phrases, and the smallest and
    largest start of one (``first_word``, ``last_word``; null without one);
    ``base_labels``; ``detections`` with label, words from ``start`` to ``end``
    (exclusive), priority and strength. A null or empty text has no words.
    Repeated documents give a row each; where kept columns are called like the
    results, ``prefix`` sets the results apart.
    """
    names = [prefix + name for name in RESULT]
    slim = docs.select(*keep, F.col("text").alias("__text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)
    added = ", ".join(f"`{name}` {kind}" for name, kind in zip(names, RESULT.values(), strict=True))
    return slim.mapInArrow(lambda b: _scan(b, names, RULES if rules is None else rules), f"{kept}, {added}")


def digest(found: DataFrame) -> DataFrame:
    """One plain row per document; the score is the chance that any label holds."""
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", F.transform("detections", lambda d: d["label"]))))
    # A base phrase counts like a detection of strength 0.8.
    doubt = F.aggregate(F.transform("detections", lambda d: 1 - d["strength"]), F.lit(1.0), lambda a, x: a * x)
    score = 1 - doubt * F.when(F.col("n_base") > 0, 0.2).otherwise(1.0)
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.concat_ws(",", "base_labels").alias("base_labels"),
        F.concat_ws(",", labels).alias("labels"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(score, 6))).alias("score"),
    )
