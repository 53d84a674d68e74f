"""License scans: ordered signature rules gated by keywords, overlaps resolved by priority.

The rules are regular expressions over lower-cased text in which every run of white space,
with the comment signs at the ends of lines in it, is one space: for each license its name,
its short tag, its address and phrases of grant, plus general notices. That text is reduced
to words; an Aho-Corasick scan over the keywords, inside words too, tells which rules can
match at all, and only those are run, over the whole text. Places of detections are those of
the original text. Detections are then taken in order of priority,
length and position, and one that lies inside a taken one is suppressed.

Besides, base phrases are counted wherever their words stand consecutively; their labels
always stay.

``score`` is 0 without a label, else the highest confidence of a kept detection (a tag or
address 1.0, a grant 0.9, a name 0.7, a notice 0.5).

Defined cases: null or empty text has no words and no labels; every row is scanned by
itself, so null or repeated ids, repeated rows and ties do not matter; an empty table gives
no rows.
"""

from __future__ import annotations

import bisect
import functools
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from trisk.llm.decontaminate import normal_form
from trisk.llm.store import columns, id_field, text_batches

#: Base phrases (words) and their labels.
BASE = ((b" cc by ", "cc-by"), (b" general public license ", "gpl"), (b" all rights reserved ", "reserved"))

# License label, SPDX tags, name pattern, keyword that any match of the name
# contains as consecutive words, address pattern ('' where there is none).
LICENSES = (
    ("mit", "mit|mit-0|x11", r"(?:mit|expat|x11)(?:[ /]x11)?", "mit|expat|x11", r"opensource\.org/licenses?/mit"),
    ("apache-1.1", "apache-1\\.1", r"apache(?: software)? licen[sc]e,?(?: version)? v?1\.1", "apache", r"apache\.org/licenses/license-1\.1"),
    ("apache-2.0", "apache-2\\.0", r"apache(?: software)? licen[sc]e(?:,? (?:version|v)? ?v?2(?:\.0)?)?", "apache", r"apache\.org/licenses/license-2\.0"),
    ("bsd-2-clause", "bsd-2-clause", r"(?:simplified|freebsd|2-clause|two-clause) bsd|bsd[ -]2[ -]clause", "bsd", r"opensource\.org/licenses?/bsd-2-clause"),
    ("bsd-3-clause", "bsd-3-clause", r"(?:new|modified|revised|3-clause|three-clause) bsd|bsd[ -]3[ -]clause", "bsd", r"opensource\.org/licenses?/bsd-3-clause"),
    ("bsd", "0bsd|bsd-4-clause", r"bsd(?:[ -]style)?", "bsd", r"opensource\.org/licenses?/bsd"),
    ("isc", "isc", r"isc", "isc", r"opensource\.org/licenses?/isc"),
    ("zlib", "zlib", r"zlib(?:/libpng)?", "zlib", r"opensource\.org/licenses?/zlib"),
    ("boost-1.0", "bsl-1\\.0", r"boost software", "boost", r"boost\.org/license_1_0"),
    ("gpl-2.0", "gpl-2\\.0(?:-only|-or-later|\\+)?", r"(?:gnu )?general public licen[sc]e,?(?: as published by the free software foundation[;,]?(?: either)?)?,? (?:version|v)\.? ?2", "general public", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2"),
    ("gpl-3.0", "gpl-3\\.0(?:-only|-or-later|\\+)?", r"(?:gnu )?general public licen[sc]e,?(?: as published by the free software foundation[;,]?(?: either)?)?,? (?:version|v)\.? ?3", "general public", r"gnu\.org/licenses/gpl-3"),
    ("gpl", "gpl", r"(?:gnu )?general public licen[sc]e|gnu gpl", "general public|gpl", r"gnu\.org/(?:licenses|copyleft)/gpl"),
    ("lgpl-2.1", "lgpl-2\\.1(?:-only|-or-later|\\+)?", r"(?:gnu )?(?:lesser|library) general public licen[sc]e,? (?:version|v)\.? ?2(?:\.1)?", "general public", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2"),
    ("lgpl-3.0", "lgpl-3\\.0(?:-only|-or-later|\\+)?", r"(?:gnu )?lesser general public licen[sc]e,? (?:version|v)\.? ?3", "general public", r"gnu\.org/licenses/lgpl-3"),
    ("agpl-3.0", "agpl-3\\.0(?:-only|-or-later|\\+)?", r"(?:gnu )?affero general public licen[sc]e(?:,? (?:version|v)\.? ?3)?", "affero", r"gnu\.org/licenses/agpl"),
    ("gfdl", "gfdl-1\\.[123](?:-only|-or-later)?", r"(?:gnu )?free documentation licen[sc]e", "free documentation", r"gnu\.org/(?:licenses|copyleft)/fdl"),
    ("mpl-1.1", "mpl-1\\.1", r"mozilla public licen[sc]e,?(?: version| v)? ?1\.1", "mozilla", r"mozilla\.org/mpl/(?:mpl-)?1\.1"),
    ("mpl-2.0", "mpl-2\\.0", r"mozilla public licen[sc]e(?:,?(?: version| v\.?)? ?2(?:\.0)?)?", "mozilla", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("epl-1.0", "epl-1\\.0", r"eclipse public licen[sc]e(?: -)?,?(?: version| v)? ?1(?:\.0)?", "eclipse", r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", "epl-2\\.0", r"eclipse public licen[sc]e(?: -)?(?:,?(?: version| v)? ?2(?:\.0)?)?", "eclipse", r"eclipse\.org/legal/epl-2\.0"),
    ("cddl", "cddl-1\\.[01]", r"common development and distribution licen[sc]e", "common development", r"opensource\.org/licenses?/cddl"),
    ("artistic-2.0", "artistic-[12]\\.0(?:-perl)?", r"artistic", "artistic", r"opensource\.org/licenses?/artistic"),
    ("cc0-1.0", "cc0-1\\.0", r"cc0(?: 1\.0)?(?: universal)?|creative commons zero", "cc0|creative commons", r"creativecommons\.org/publicdomain/zero"),
    ("cc-by-nc-nd", "cc-by-nc-nd-[1-4]\\.[05]", r"(?:cc[ -]by[ -]nc[ -]nd|creative commons attribution[ -]non-?commercial[ -]no-?deriv(?:ative)?s?(?: works)?)(?: [1-4]\.[05])?", "cc by|creative commons", r"creativecommons\.org/licenses/by-nc-nd"),
    ("cc-by-nc-sa", "cc-by-nc-sa-[1-4]\\.[05]", r"(?:cc[ -]by[ -]nc[ -]sa|creative commons attribution[ -]non-?commercial[ -]share-?alike)(?: [1-4]\.[05])?", "cc by|creative commons", r"creativecommons\.org/licenses/by-nc-sa"),
    ("cc-by-nc", "cc-by-nc-[1-4]\\.[05]", r"(?:cc[ -]by[ -]nc|creative commons attribution[ -]non-?commercial)(?: [1-4]\.[05])?", "cc by|creative commons", r"creativecommons\.org/licenses/by-nc"),
    ("cc-by-nd", "cc-by-nd-[1-4]\\.[05]", r"(?:cc[ -]by[ -]nd|creative commons attribution[ -]no-?deriv(?:ative)?s?)(?: [1-4]\.[05])?", "cc by|creative commons", r"creativecommons\.org/licenses/by-nd"),
    ("cc-by-sa", "cc-by-sa-[1-4]\\.[05]", r"(?:cc[ -]by[ -]sa|creative commons attribution[ -]share-?alike)(?: [1-4]\.[05])?", "cc by|creative commons", r"creativecommons\.org/licenses/by-sa"),
    ("cc-by", "cc-by-[1-4]\\.[05]", r"(?:cc[ -]by|creative commons attribution)(?: [1-4]\.[05])?", "cc by|creative commons", r"creativecommons\.org/licenses/by"),
    ("odbl", "odbl-1\\.0", r"open data(?:base| commons open database) licen[sc]e", "open data", r"opendatacommons\.org/licenses/odbl"),
    ("ofl-1.1", "ofl-1\\.1", r"sil open font", "open font", r"scripts\.sil\.org/ofl"),
    ("unlicense", "unlicense", r"unlicense", "unlicense", r"unlicense\.org"),
    ("wtfpl", "wtfpl", r"do what the f\w* you want to public|wtfpl", "wtfpl|do what the", r"wtfpl\.net"),
    ("psf-2.0", "psf-2\\.0|python-2\\.0", r"(?:python software foundation|psf)", "python software|psf", r"docs\.python\.org/\d(?:\.\d+)?/license"),
    ("postgresql", "postgresql", r"postgresql", "postgresql", r"opensource\.org/licenses?/postgresql"),
    ("openssl", "openssl", r"openssl", "openssl", r"openssl\.org/source/license"),
    ("ms-pl", "ms-pl", r"microsoft public|ms-pl", "microsoft public|ms pl", r"opensource\.org/licenses?/ms-pl"),
    ("ms-rl", "ms-rl", r"microsoft reciprocal|ms-rl", "microsoft reciprocal|ms rl", r"opensource\.org/licenses?/ms-rl"),
    ("eupl-1.2", "eupl-1\\.[12]", r"european union public licen[sc]e|eupl", "european union public|eupl", r"joinup\.ec\.europa\.eu/\S*eupl"),
    ("cecill", "cecill-[bc]|cecill-[12]\\.[01]", r"cecill(?:-[bc])?", "cecill", r"cecill\.info"),
    ("php", "php-3\\.0[1]?", r"php", "php", r"php\.net/license"),
    ("ruby", "ruby", r"ruby", "ruby", r"ruby-lang\.org/en/about/license"),
    ("vim", "vim", r"vim", "vim", r"vimhelp\.org/uganda"),
    ("afl-3.0", "afl-[123]\\.[01]", r"academic free", "academic free", r"opensource\.org/licenses?/afl"),
    ("osl-3.0", "osl-[123]\\.[01]", r"open software", "open software", r"opensource\.org/licenses?/osl"),
    ("sspl-1.0", "sspl-1\\.0", r"server side public", "server side", r"mongodb\.com/licensing/server-side"),
    ("busl-1.1", "busl-1\\.1", r"business source", "business source", r"mariadb\.com/bsl11"),
    ("elastic-2.0", "elastic-2\\.0", r"elastic", "elastic", r"elastic\.co/licensing"),
    ("upl-1.0", "upl-1\\.0", r"universal permissive", "universal permissive", r"oss\.oracle\.com/licenses/upl"),
    ("ncsa", "ncsa", r"university of illinois(?:/ncsa)?(?: open source)?|ncsa", "university of illinois|ncsa", r"opensource\.org/licenses?/ncsa"),
)

# General notices as (label, pattern, keyword).
NOTICES = (
    ("reserved", r"all rights? (?:are )?reserved|alle rechte vorbehalten|tous droits r[ée]serv[ée]s|todos los derechos reservados", "reserved|vorbehalten|droits|derechos"),
    ("copyright", r"(?:copyright|\(c\)|©) ?(?:\(c\)|©)? ?(?:19|20)\d\d", "copyright|c|©"),
    ("public-domain", r"(?:in|into|to) the public domain", "public domain"),
    ("proprietary", r"(?:proprietary and confidential|unauthori[sz]ed (?:copying|use|distribution))", "proprietary|unauthorized|unauthorised"),
    ("permission-notice", r"permission is hereby granted, free of charge", "permission is hereby"),
    ("no-warranty", r"(?:provided|distributed) [\"']?as[ -]is[\"']?", "as is"),
    ("free-software", r"this (?:program|library|software) is free software", "free software"),
)

#: Ways a license is named: (priority, confidence, pattern with NAME).
FORMS = (
    (40, 0.9, r"(?:licen[sc]ed|released|distributed|available|published|provided|redistribut\w+)(?: \w+)? under (?:the )?(?:terms of )?(?:the )?(?:NAME)(?:[ -]licen[sc]e)?\b"),
    (35, 0.9, r"(?:subject to|governed by|covered by|under) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?(?:NAME)[ -]licen[sc]e\b"),
    (30, 0.7, r"\b(?:NAME)[ -](?:open source |public )?licen[sc]e\b"),
    (28, 0.7, r"\blicen[sc]e ?[:=] ?[\"']?(?:the )?(?:NAME)\b"),
)
#: White space to be read as one space, with comment signs that end or start lines in it.
_GAP = re.compile(r"(?:[ \t]+[*#;%/]+)?[^\S\n]*\n(?:\s*(?://+|/\*+|\*+/?|#+|;+|--+|%+|>+|!+|dnl\b|rem\b))*\s*|\s{2,}|[^\S ]")
#: Names that say "license" or a version themselves also count alone.
_ALONE = re.compile(r"licen\[sc\]e|\bcc|gpl|cecill|eupl|wtfpl|unlicense")


@dataclass(frozen=True)
class Rule:
    """One signature: the higher the priority, the earlier its detections are taken."""

    order: int
    label: str
    priority: int
    confidence: float
    pattern: re.Pattern
    keywords: tuple[str, ...]


@functools.lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules in their order."""
    out: list[Rule] = []

    def add(label, priority, confidence, pattern, keywords):
        out.append(Rule(len(out), label, priority, confidence, re.compile(pattern), tuple(keywords.split("|"))))

    for label, tags, name, keyword, address in LICENSES:
        add(label, 60, 1.0, rf"spdx-licen[sc]e-identifier: ?\(?(?:{tags})\b", "spdx license identifier|spdx licence identifier")
        if address:
            add(label, 50, 1.0, rf"(?:https?://)?(?:www\.)?{address}\b", " ".join(re.findall(r"[a-z]+", address.split("/")[0].replace("\\.", " "))))
        for priority, confidence, form in FORMS:
            add(label, priority, confidence, form.replace("NAME", name), keyword)
        if _ALONE.search(name):
            add(label, 20, 0.7, rf"\b(?:{name})(?!\w)", keyword)
    for label, pattern, keyword in NOTICES:
        add(label, 10, 0.5, pattern, keyword)
    return tuple(out)


@functools.lru_cache(maxsize=1)
def _gates():
    """(automaton of keywords, rules by keyword)."""
    import ahocorasick
    by_word: dict[str, list[Rule]] = {}
    for rule in rules():
        for k in rule.keywords:
            word = normal_form(k).decode("latin-1")
            # A rule may match inside a word or next to signs that count as part of one; (c) stands alone.
            by_word.setdefault(word if len(k) == 1 and k.isascii() else word.strip(" "), []).append(rule)
    machine = ahocorasick.Automaton()
    for k, own in by_word.items():
        machine.add_word(k, own)
    machine.make_automaton()
    return machine


def flattened(text: str) -> tuple[str, list[int], list[int]]:
    """The lower-cased text with single spaces for gaps, and where its pieces start: in it, in the text."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower()[0] for c in text)
    pieces, flat_at, text_at, end, size = [], [0], [0], 0, 0
    for m in _GAP.finditer(low):
        pieces.append(low[end:m.start()])
        size += m.start() - end + 1
        end = m.end()
        flat_at.append(size)
        text_at.append(end)
    return " ".join([*pieces, low[end:]]), flat_at, text_at


def detections(text: str) -> list[tuple[int, int, Rule]]:
    """Kept detections (start, end, rule) in the text, in position order."""
    flat, flat_at, text_at = flattened(text)
    able = {r.order: r for _, own in _gates().iter(normal_form(flat).decode("latin-1")) for r in own}

    def place(at: int) -> int:
        k = bisect.bisect_right(flat_at, at) - 1
        return text_at[k] + at - flat_at[k]

    found = [(place(m.start()), place(m.end() - 1) + 1, r) for r in able.values() for m in r.pattern.finditer(flat)]
    found.sort(key=lambda d: (-d[2].priority, d[0] - d[1], d[2].order, d[0]))
    kept: list[tuple[int, int, Rule]] = []
    starts: list[int] = []  # of kept ones, sorted; reach: how far those from a start go
    reach: dict[int, int] = {}
    longest = max((b - a for a, b, _ in found), default=0)
    for a, b, rule in found:
        k = bisect.bisect_right(starts, a) - 1
        while k >= 0 and starts[k] >= b - longest and reach[starts[k]] < b:
            k -= 1
        if k < 0 or starts[k] < b - longest:
            kept.append((a, b, rule))
            if a not in reach:
                bisect.insort(starts, a)
            reach[a] = max(reach.get(a, 0), b)
    return sorted(kept, key=lambda d: (d[0], d[1], d[2].order))


def base_places(hay: bytes) -> list[tuple[int, str]]:
    """(word number, label) of every place of a base phrase."""
    out = []
    for phrase, label in BASE:
        at = hay.find(phrase)
        while at >= 0:
            out.append((hay.count(b" ", 0, at), label))
            at = hay.find(phrase, at + 1)
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts, labels, score and the kept detections."""
    rows = columns(docs, doc_id=id_col, text=text_col)
    hit = T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType()),
                        T.StructField("end", T.LongType()), T.StructField("confidence", T.DoubleType())])
    schema = T.StructType([id_field(rows, "doc_id"), T.StructField("n_words", T.LongType()),
                           T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()),
                           T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.StringType()),
                           T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("detections", T.ArrayType(hit))])
    hits = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("confidence", pa.float64())]))

    def run(batches):
        for batch, texts in text_batches(batches, "text"):
            out = []
            for text in texts:
                hay = normal_form(text)
                base = base_places(hay)
                kept = detections(text)
                words = [w for w, _ in base]
                own = {label for _, label in base}
                out.append((hay.count(b" ") - 1, len(base), min(words, default=None), max(words, default=None),
                            ",".join(sorted(own)), ",".join(sorted(own | {r.label for _, _, r in kept})),
                            max([r.confidence for _, _, r in kept] + [0.7] * bool(base), default=0.0),
                            [{"label": r.label, "start": a, "end": b, "confidence": r.confidence}
                             for a, b, r in kept]))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), hits]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]],
                names=schema.names)

    return rows.mapInArrow(run, schema)
