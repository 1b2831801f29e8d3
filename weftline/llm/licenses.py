"""License scans: ordered signature rules behind a keyword prefilter, with overlapping detections resolved.

Texts become lower-case words joined by single spaces; rules are regular expressions over that form. A rule runs only on
texts that hold its keyword. Detections are taken in order of priority, then length, then place; one that lies inside a
detection already taken, or overlaps one of strictly higher priority, is suppressed.

Defined results: a null or empty text has no words, no detections and score 0; a text of any length is scanned whole, in
time that grows with its length and its detections (but for sorting them); repeated rows are scanned each for itself;
further columns are not looked at, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.core import load

# fixed values: phrases that always count, and their labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# fixed values: license names as word sequences (label: pattern); every name gives one rule for each form below
NAMES = {
    "afl-3.0": r"academic free licen[sc]e(?: version)?(?: v?3(?: 0)?)?",
    "agpl-1.0": r"affero general public licen[sc]e(?: version)? v?1(?: 0)?",
    "agpl-3.0": r"(?:gnu )?affero general public licen[sc]e(?: (?:version )?v?3(?: 0)?)?",
    "apache-1.0": r"apache (?:software )?licen[sc]e(?: version)? v?1 0",
    "apache-1.1": r"apache (?:software )?licen[sc]e(?: version)? v?1 1",
    "apache-2.0": r"apache (?:software )?licen[sc]e(?: version)? v?2(?: 0)?",
    "apsl-2.0": r"apple public source licen[sc]e",
    "artistic-1.0": r"artistic licen[sc]e(?: version)? 1(?: 0)?",
    "artistic-2.0": r"artistic licen[sc]e(?: version)? 2(?: 0)?",
    "beerware": r"beer ?ware licen[sc]e",
    "blueoak-1.0.0": r"blue oak model licen[sc]e",
    "bsd-1-clause": r"(?:1|one) clause bsd(?: licen[sc]e)?",
    "bsd-2-clause": r"(?:(?:2|two) clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?",
    "bsd-3-clause": r"(?:(?:3|three) clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?",
    "bsd-4-clause": r"(?:(?:4|four) clause bsd|original bsd)(?: licen[sc]e)?",
    "bsl-1.0": r"boost software licen[sc]e",
    "busl-1.1": r"business source licen[sc]e",
    "catosl-1.1": r"computer associates trusted open source licen[sc]e",
    "cc0-1.0": r"(?:cc0|cc zero|creative commons zero)(?: 1 0)?(?: universal)?",
    "cc-by-3.0": r"(?:cc by|creative commons attribution) 3 0(?: unported)?",
    "cc-by-4.0": r"(?:cc by|creative commons attribution) 4 0(?: international)?",
    "cc-by-nc-3.0": r"(?:cc by nc|creative commons attribution non ?commercial) 3 0",
    "cc-by-nc-4.0": r"(?:cc by nc|creative commons attribution non ?commercial) 4 0(?: international)?",
    "cc-by-nc-nd-4.0": r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s) 4 0",
    "cc-by-nc-sa-4.0": r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike) 4 0",
    "cc-by-nd-4.0": r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s) 4 0",
    "cc-by-sa-3.0": r"(?:cc by sa|creative commons attribution share ?alike) 3 0",
    "cc-by-sa-4.0": r"(?:cc by sa|creative commons attribution share ?alike) 4 0",
    "cddl-1.0": r"common development and distribution licen[sc]e",
    "cecill-2.1": r"cecill(?: free software)?(?: licen[sc]e)?",
    "cpl-1.0": r"common public licen[sc]e",
    "ecl-2.0": r"educational community licen[sc]e",
    "epl-1.0": r"eclipse public licen[sc]e(?: version)? v?1(?: 0)?",
    "epl-2.0": r"eclipse public licen[sc]e(?: version)? v?2(?: 0)?",
    "eupl-1.2": r"european union public licen[sc]e",
    "fdl-1.3": r"(?:gnu )?free documentation licen[sc]e",
    "gpl-1.0": r"(?:gnu )?general public licen[sc]e(?: version)? v?1(?: 0)?",
    "gpl-2.0": r"(?:gnu )?general public licen[sc]e(?: version)? v?2(?: 0)?",
    "gpl-3.0": r"(?:gnu )?general public licen[sc]e(?: version)? v?3(?: 0)?",
    "hpnd": r"historical permission notice and disclaimer",
    "ipl-1.0": r"ibm public licen[sc]e",
    "isc": r"isc licen[sc]e",
    "lgpl-2.0": r"(?:gnu )?library general public licen[sc]e",
    "lgpl-2.1": r"(?:gnu )?lesser general public licen[sc]e(?: version)? v?2(?: 1)?",
    "lgpl-3.0": r"(?:gnu )?lesser general public licen[sc]e(?: version)? v?3(?: 0)?",
    "lppl-1.3c": r"latex project public licen[sc]e",
    "mit": r"mit licen[sc]e",
    "mit-0": r"mit no attribution(?: licen[sc]e)?",
    "mpl-1.1": r"mozilla public licen[sc]e(?: version)? v?1 1",
    "mpl-2.0": r"mozilla public licen[sc]e(?: version)? v?2(?: 0)?",
    "ms-pl": r"microsoft public licen[sc]e",
    "ms-rl": r"microsoft reciprocal licen[sc]e",
    "mulanpsl-2.0": r"mulan permissive software licen[sc]e",
    "ncsa": r"(?:university of illinois )?ncsa open source licen[sc]e",
    "odbl-1.0": r"open (?:data commons open )?database licen[sc]e",
    "odc-by-1.0": r"open data commons attribution licen[sc]e",
    "ofl-1.1": r"(?:sil )?open font licen[sc]e",
    "osl-3.0": r"open software licen[sc]e",
    "php-3.01": r"php licen[sc]e",
    "postgresql": r"postgresql licen[sc]e",
    "python-2.0": r"python (?:software foundation )?licen[sc]e",
    "qpl-1.0": r"q public licen[sc]e",
    "rail": r"(?:open )?rail(?: m)? licen[sc]e",
    "rpl-1.5": r"reciprocal public licen[sc]e",
    "sspl-1.0": r"server side public licen[sc]e",
    "unicode": r"unicode licen[sc]e(?: agreement)?",
    "unlicense": r"(?:the )?unlicense",
    "upl-1.0": r"universal permissive licen[sc]e",
    "w3c": r"w3c software (?:notice and )?licen[sc]e",
    "wtfpl": r"(?:wtfpl|do what the fuck you want to public licen[sc]e)",
    "zlib": r"zlib(?: libpng)? licen[sc]e",
    "zpl-2.1": r"zope public licen[sc]e",
    "aladdin": r"aladdin free public licen[sc]e",
    "apsl-1.0": r"apple public source licen[sc]e(?: version)? 1(?: 0)?",
    "bittorrent-1.1": r"bittorrent open source licen[sc]e",
    "bsd-0-clause": r"(?:0|zero) clause bsd(?: licen[sc]e)?",
    "bsd-patent": r"bsd (?:2 clause )?plus patent(?: licen[sc]e)?",
    "cal-1.0": r"cryptographic autonomy licen[sc]e",
    "cc-by-1.0": r"(?:cc by|creative commons attribution) 1 0(?: generic)?",
    "cc-by-2.0": r"(?:cc by|creative commons attribution) 2 0(?: generic)?",
    "cc-by-2.5": r"(?:cc by|creative commons attribution) 2 5(?: generic)?",
    "cc-by-nc-2.0": r"(?:cc by nc|creative commons attribution non ?commercial) 2 0",
    "cc-by-nc-nd-3.0": r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s) 3 0",
    "cc-by-nc-sa-3.0": r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike) 3 0",
    "cc-by-nd-3.0": r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s) 3 0",
    "cc-by-sa-2.0": r"(?:cc by sa|creative commons attribution share ?alike) 2 0",
    "cc-by-sa-2.5": r"(?:cc by sa|creative commons attribution share ?alike) 2 5",
    "cc-pddc": r"creative commons public domain(?: dedication)?",
    "cdla-permissive-2.0": r"community data licen[sc]e agreement permissive",
    "cdla-sharing-1.0": r"community data licen[sc]e agreement sharing",
    "cern-ohl-2.0": r"cern open hardware licen[sc]e",
    "cnri-python": r"cnri (?:python )?open source licen[sc]e",
    "condor-1.1": r"condor public licen[sc]e",
    "copyleft-next": r"copyleft next",
    "cpal-1.0": r"common public attribution licen[sc]e",
    "crossword": r"crossword licen[sc]e",
    "cua-opl-1.0": r"cua office public licen[sc]e",
    "d-fsl-1.0": r"deutsche freie software lizenz",
    "dl-de-by-2.0": r"datenlizenz deutschland",
    "doc": r"doc software licen[sc]e",
    "efl-2.0": r"eiffel forum licen[sc]e",
    "elastic-2.0": r"elastic licen[sc]e",
    "entessa": r"entessa public licen[sc]e",
    "erlpl-1.1": r"erlang public licen[sc]e",
    "etalab-2.0": r"licence ouverte(?: etalab)?",
    "eudatagrid": r"eu datagrid software licen[sc]e",
    "fair": r"fair licen[sc]e",
    "fair-source": r"fair source licen[sc]e",
    "frameworx-1.0": r"frameworx open licen[sc]e",
    "freetype": r"free ?type (?:project )?licen[sc]e",
    "functional-source": r"functional source licen[sc]e",
    "gfdl-1.2": r"(?:gnu )?free documentation licen[sc]e(?: version)? 1 2",
    "giftware": r"gift ?ware licen[sc]e",
    "hippocratic": r"hippocratic licen[sc]e",
    "icu": r"icu licen[sc]e",
    "ijg": r"independent jpeg group licen[sc]e",
    "imlib2": r"imlib2 licen[sc]e",
    "intel": r"intel open source licen[sc]e",
    "jam": r"jam licen[sc]e",
    "jpnic": r"japan network information center licen[sc]e",
    "json": r"json licen[sc]e",
    "libpng": r"libpng licen[sc]e",
    "licence-art-libre": r"licence art libre",
    "lpl-1.02": r"lucent public licen[sc]e",
    "miros": r"miros licen[sc]e",
    "motosoto": r"motosoto open source licen[sc]e",
    "mulan-publ-2.0": r"mulan public licen[sc]e",
    "multics": r"multics licen[sc]e",
    "naumen": r"naumen public licen[sc]e",
    "nethack": r"nethack general public licen[sc]e",
    "netscape-1.1": r"netscape public licen[sc]e",
    "nasa-1.3": r"nasa open source agreement",
    "nokia": r"nokia open source licen[sc]e",
    "non-commercial-government": r"non commercial government licen[sc]e",
    "oclc-2.0": r"oclc research public licen[sc]e",
    "ogl-uk-3.0": r"open government licen[sc]e",
    "oldap-2.8": r"openldap public licen[sc]e",
    "opl-1.0": r"open publication licen[sc]e",
    "openssl": r"open ?ssl licen[sc]e",
    "parity": r"parity public licen[sc]e",
    "pddl-1.0": r"open data commons public domain dedication",
    "polyform-nc": r"polyform non ?commercial licen[sc]e",
    "prosperity": r"prosperity public licen[sc]e",
    "realnetworks": r"realnetworks public source licen[sc]e",
    "ricoh": r"ricoh source code public licen[sc]e",
    "ruby": r"ruby licen[sc]e",
    "sissl": r"sun industry standards source licen[sc]e",
    "sleepycat": r"sleepycat licen[sc]e",
    "spl-1.0": r"sun public licen[sc]e",
    "sugarcrm-1.1": r"sugar ?crm public licen[sc]e",
    "tapr-ohl": r"tapr open hardware licen[sc]e",
    "tcl": r"tcl tk licen[sc]e",
    "vim": r"vim licen[sc]e",
    "vsl-1.0": r"vovida software licen[sc]e",
    "watcom-1.0": r"sybase open watcom public licen[sc]e",
    "x11": r"x11 licen[sc]e",
    "xfree86": r"xfree86 licen[sc]e",
    "xnet": r"x net licen[sc]e",
    "yahoo": r"yahoo public licen[sc]e",
    "zend-2.0": r"zend (?:engine )?licen[sc]e",
    "zimbra-1.4": r"zimbra public licen[sc]e",
}

# fixed values: how a name is used (form: priority, weight, pattern around the name, keywords of which a text must hold one)
FORMS = {
    "grant": (1, 0.95, r"(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?{}", ("under",)),
    "notice": (2, 0.9, r"(?:this|the) (?:work|software|file|program|project|document|text|content|dataset) is (?:\w+ ){{0,3}}(?:the )?{}", ("is",)),
    "copy": (3, 0.85, r"(?:copy of|see|subject to|comply with|terms of|conditions of) (?:the )?{}", ("of", "see", "to", "with")),
    "name": (4, 0.7, r"{}", ("",)),
}

# fixed values: rules that stand alone (label, priority, weight, keyword, pattern)
SINGLE = (
    ("mit", 1, 0.98, "permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", 1, 0.98, "permission", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", 1, 0.95, "redistribution", r"redistribution and use in source and binary forms with or without modification"),
    ("bsd-3-clause", 1, 0.95, "neither", r"neither the name of [^ ]+(?: [^ ]+){0,8} nor the names of its contributors"),
    ("unlicense", 1, 0.98, "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("zlib", 1, 0.98, "altered", r"altered source versions must be plainly marked as such"),
    ("wtfpl", 1, 0.98, "fuck", r"you just do what the fuck you want to"),
    ("public-domain", 2, 0.8, "domain", r"(?:dedicated to|released into|placed in|in) the public domain"),
    ("copyright", 3, 0.6, "copyright", r"copyright(?: c)? (?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?"),
    ("proprietary", 2, 0.8, "proprietary", r"(?:proprietary and confidential|confidential and proprietary)"),
    ("no-redistribution", 2, 0.7, "without", r"(?:may not|not) be (?:copied|redistributed)(?: or [a-z]+)? without"),
    ("permission-required", 3, 0.6, "permission", r"without (?:the )?(?:prior |express )?(?:written )?permission"),
    ("license-file", 4, 0.4, "licen", r"(?:see|refer to) (?:the )?(?:file )?(?:named )?licen[sc]e(?: txt| md)?(?: file)?(?: for details)?"),
    ("spdx", 2, 0.9, "spdx", r"spdx license identifier [a-z0-9]+(?: [0-9a-z]+){0,4}"),
    ("warranty", 4, 0.4, "warrant", r"without warrant(?:y|ies) (?:of any kind|or conditions of any kind)"),
    ("terms", 5, 0.3, "licensed", r"licensed (?:to|under) "),
)


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    priority: int
    weight: float
    gate: str
    keywords: tuple[str, ...]
    pattern: re.Pattern


# fixed values: words of so many licenses' names that they tell little
COMMON = {"licen", "public", "general", "source", "software", "open", "free", "attribution", "creative", "commons", "agreement"}


def keywords_of(pattern: str) -> tuple[str, tuple[str, ...]]:
    """What a text must hold for the pattern to match: ``licen`` or nothing, and one of some literals, the most telling of what
    stands outside optional groups, or one for each alternative."""
    flat = re.sub(r"\(\?:(?:[^()]|\([^()]*\))*\)\?", "#", pattern).replace("licen[sc]e", "licen")
    flat = re.sub(r"[^()]\?", "#", flat)  # what may be missing parts what stands beside it
    groups = re.findall(r"\(\?:((?:[^()]|\([^()]*\))*)\)", flat)
    literals = re.findall(r"[a-z0-9]{3,}", re.sub(r"\(\?:(?:[^()]|\([^()]*\))*\)", "#", flat))
    gate, outside = "licen" if "licen" in literals else "", max([x for x in literals if x not in COMMON] or literals, key=len, default="")
    if outside and outside != "licen":
        return gate, (outside,)
    options = []
    for x in groups[0].split("|") if groups else []:
        words = re.findall(r"[a-z0-9]+", re.sub(r"\(.*?\)", "#", x))
        options.append(x.strip() if re.fullmatch("[a-z0-9 ]+", x) else max([w for w in words if w not in COMMON] or words, key=len, default=""))
    return gate, tuple(options) if options and all(options) else (outside,)


def rules() -> list[Rule]:
    """All rules, in order of priority."""
    edge = r"(?<![^ ]){}(?![^ ])"
    out = [
        Rule(f"{label}:{form}", label, priority, weight, *keywords_of(pattern), re.compile(edge.format(f"(?:{around.format(f'(?:{pattern})')})")))
        for label, pattern in NAMES.items()
        for form, (priority, weight, around, _) in FORMS.items()
    ]
    out += [Rule(f"{label}:{keyword}", label, priority, weight, "", (keyword,), re.compile(edge.format(f"(?:{pattern.strip()})"))) for label, priority, weight, keyword, pattern in SINGLE]
    return sorted(out, key=lambda r: (r.priority, r.name))


TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def resolve(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Detections (start, end, rule) that nothing of their own or higher priority contains, nor of higher priority overlaps.

    Priority by priority: what is left beside the stretches taken before is swept from left to right, where a detection
    lies inside another just if one that began no later ends no earlier. Of equal ones the first by name stays.
    """
    kept: list[tuple[int, int, Rule]] = []
    taken_from, taken_to = np.zeros(0, "i8"), np.zeros(0, "i8")  # disjoint stretches, in order
    for priority in sorted({rule.priority for _, _, rule in found}):
        own = sorted((d for d in found if d[2].priority == priority), key=lambda d: (d[0], -d[1], d[2].name))
        starts, ends = (np.array([d[k] for d in own], "i8") for k in (0, 1))
        before = np.searchsorted(taken_from, ends, side="left")  # stretches that begin before the detection ends
        free = (before == 0) | (taken_to[np.maximum(before - 1, 0)] <= starts) if len(taken_to) else np.ones(len(own), bool)
        furthest = -1
        for d, ok in zip(own, free.tolist()):
            if ok and d[1] > furthest:
                kept.append(d)
                furthest = d[1]
        edges = sorted([(d[0], d[1]) for d in kept])
        taken_from, taken_to = np.array([a for a, _ in edges], "i8"), np.maximum.accumulate(np.array([b for _, b in edges], "i8"))
        new = np.concatenate([[True], taken_from[1:] > taken_to[:-1]])
        last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(new) - 1]])
        taken_from, taken_to = taken_from[new], taken_to[last]
    return sorted(kept, key=lambda d: (d[0], d[1], d[2].name))


class Scanner:
    def __init__(self):
        self.base = [(re.compile(f"(?<![^ ])(?={phrase}(?![^ ]))"), phrase.split()[-1].encode(), phrase, label) for phrase, label in BASE.items()]
        self.by_gate: dict[bytes, dict[bytes, list[Rule]]] = {}
        for rule in rules():
            for k in rule.keywords:
                self.by_gate.setdefault(rule.gate.encode(), {}).setdefault(k.encode(), []).append(rule)

    def scan(self, text: str | None) -> dict:
        words = (text or "").encode().translate(TO_WORDS).split()
        flat = b" ".join(words)
        out = {"n_words": len(words), "base": [], "detections": [], "score": 0.0}
        base = [x for x in self.base if x[1] in flat]
        live = {r.name: r for gate, by_keyword in self.by_gate.items() if gate in flat for k, rs in by_keyword.items() if k in flat for r in rs}
        if not base and not live:
            return out
        line = flat.decode()
        found = [(m.start(), m.end(), rule) for rule in live.values() for m in rule.pattern.finditer(line)]
        places = [(phrase, label, [m.start() for m in pattern.finditer(line)]) for pattern, _, phrase, label in base]
        blanks = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), "<u4") == 32) if found or any(x for _, _, x in places) else None
        at = lambda pos: int(np.searchsorted(blanks, pos))  # noqa: E731  the word that stands there
        for phrase, label, starts in places:
            out["base"] += [{"label": label, "start": at(pos), "words": phrase.count(" ") + 1} for pos in starts]
        miss = 1.0
        for start, end, rule in resolve(found):
            out["detections"].append({"label": rule.label, "rule": rule.name, "start": at(start), "words": line.count(" ", start, end) + 1, "matched": line[start:end]})
            miss *= 1 - rule.weight
        for _ in {b["label"] for b in out["base"]}:
            miss *= 0.5
        out["score"] = 1 - miss
        return out


@functools.cache
def scanner() -> Scanner:
    """One for each process: its patterns take a while to compile."""
    return Scanner()


FOUND = pa.struct([("label", pa.string()), ("start", pa.int64()), ("words", pa.int64())])
DETECTED = pa.struct([("label", pa.string()), ("rule", pa.string()), ("start", pa.int64()), ("words", pa.int64()), ("matched", pa.string())])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, base, detections, score): base phrases and resolved detections with their first word and number of words."""
    kinds = {"n_words": pa.int64(), "base": pa.list_(FOUND), "detections": pa.list_(DETECTED), "score": pa.float64()}

    def run(batches):
        scan = scanner().scan
        for batch in batches:
            rows = [scan(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array([r[k] for r in rows], kind) for k, kind in kinds.items())], ["doc_id", *kinds])

    schema = "doc_id long, n_words long, base array<struct<label string, start long, words long>>, detections array<struct<label string, rule string, start long, words long, matched string>>, score double"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts, base = F.transform("base", lambda x: x["start"]), F.transform("base", lambda x: x["label"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return scan_licenses(load(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.transform("detections", lambda x: x["label"]))).alias("labels"),
        "score",
    )
