"""Personal data by candidate gradient boosting.

Fixed patterns give the base spans.  Wider generators propose overlapping
candidates of each kind (spelled-out addresses, numbers in other groupings);
boosted trees score them from their format and their context, and those above
their kind's threshold, calibrated on held-out candidates, are added where they
overlap no other span.  Positive in training are candidates that overlap a base
span, base spans rewritten into the wider forms where they stand, and numbers
of the right shape right after a cue word, so the trees learn the forms that
the patterns miss.  Unmatched candidates next to a
cue of their kind may be personal data and are no negatives.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from needbridge.llm.boosting import BoostedTrees, calibrated_threshold

KINDS = ("email", "ip", "card", "phone")
#: Documents whose candidates train the trees, at most; seed of that sample.
TRAIN_DOCS, TRAIN_SEED = 8_000, 17
PRECISION = 0.95
#: The base patterns.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: Candidates: spelled-out or spaced addresses; numbers in any grouping.
_ADDRESS = re.compile(r"[\w.%+-]{1,64}(?: ?[\[(]? ?(?:@|\bat\b) ?[\])]? ?)[\w-]{1,63}"
                      r"(?:(?: ?[\[(]? ?(?:\.|\bdot\b) ?[\])]? ?)[\w-]{1,63}){1,4}")
_NUMBER = re.compile(r"[+(]{0,2}[0-9][0-9\x20().,:/-]{5,38}[0-9]")
_CUES = tuple(re.compile(c) for c in (
    r"mail|contact|write|@|schreib|correo|courriel", r"\bip\b|host|server|addr|login", r"card|visa|karte|tarjeta|carte|pay",
    r"tel|phone|call|fax|mobil|ruf|llama|appel"))
_DATE = re.compile(r"[0-9]{1,4}([/.-])[0-9]{1,2}\1[0-9]{1,4}")
#: Ways to write what stands for @ and for the dots of a domain.
_SPELLED = ((" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "."), (" at ", "."))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local@domain: each @ closes the longest run of local characters left of it."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def _digits(part: str) -> str:
    return "".join(c for c in part if c in "0123456789")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans [start, end) in code points of each kind, leftmost and not overlapping."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = _emails(text)
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out["ip"].append(m.span())
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out["card"].append(m.span())
    if "+" in text:
        out["phone"] = [m.span() for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return out


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end): every generator's proposals; a number is proposed as ip, card and phone."""
    out = []
    if any(x in text for x in ("@", " dot ", "(at)", "[at]", "(dot)", "[dot]")):
        out += [(0, *m.span()) for m in _ADDRESS.finditer(text)]
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            n = sum(c.isdecimal() for c in m.group())
            out += [(kind, *m.span()) for kind, lo, hi in ((1, 4, 12), (2, 13, 19), (3, 7, 15)) if lo <= n <= hi]
    return out


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    part = text[start:end]
    groups = re.findall(r"[0-9]+", part)
    digits = "".join(groups)
    before, after = text[max(0, start - 40):start].lower(), text[end:end + 20].lower()
    sizes = [len(g) for g in groups] or [0]
    return [
        kind, end - start, len(digits), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1],
        part.count("."), part.count("-"), part.count(" "), part.count("("), part.count("/") + part.count(":") + part.count(","),
        part.startswith("+"), "@" in part, sum(c.isalpha() for c in part), luhn(digits) if digits else False,
        len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups),
        float(len(set(digits))), before[-1:].isalnum(), after[:1].isalnum(), before[-1:] in ("=", ":", "#", "$", "€"),
        *[bool(c.search(before)) for c in _CUES], *[bool(c.search(after)) for c in _CUES],
    ]


class _Cover:
    """What a set of spans covers, as disjoint sorted stretches."""

    def __init__(self, spans: Iterable[tuple[int, int]] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, start: int, end: int) -> bool:
        # of disjoint stretches, the last that starts before `end` reaches furthest
        at = bisect_left(self.starts, end) - 1
        return at >= 0 and self.ends[at] > start

    def add(self, start: int, end: int) -> None:
        """A span that meets none of the others."""
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def rewritten(text: str, kind: int, start: int, end: int, way: int) -> tuple[str, int, int]:
    """The neighbourhood of a base span with the span in a wider form: (text, start, end)."""
    part = text[start:end]
    if kind == 0:
        at, dot = _SPELLED[way % len(_SPELLED)]
        local, _, domain = part.rpartition("@")
        part = local + at + domain.replace(".", dot)
    elif kind == 1:
        part = part.replace(".", (" . ", "-", ", ")[way % 3])
    elif kind == 2:
        d = _digits(part)
        part = (".", "/", " - ")[way % 3].join(d[i:i + 4] for i in range(0, len(d), 4))
    else:
        part = ("00", "", "(0)")[way % 3] + part[1:]
    before = text[max(0, start - 80):start]
    return before + part + text[end:end + 80], len(before), len(before) + len(part)


def _cued(text: str, kind: int, start: int, end: int) -> bool:
    cue = _CUES[kind]
    return bool(cue.search(text[max(0, start - 40):start].lower()) or cue.search(text[end:end + 20].lower()))


def _evident(text: str, kind: int, start: int, end: int) -> bool:
    """A number of the right shape with a cue of its kind as the word right before it."""
    part = text[start:end]
    words = text[max(0, start - 20):start].lower().split()
    if not kind or not words or _DATE.fullmatch(part) or not _CUES[kind].search(words[-1]):
        return False
    groups, digits = re.findall("[0-9]+", part), _digits(part)
    return (len(groups) == 4 and all(int(g) <= 255 for g in groups), 16 <= len(digits) <= 19 and luhn(digits),
            8 <= len(digits) <= 15)[kind - 1]


class Model:
    """Trees and a threshold for each kind; adds nothing of a kind of which there was nothing to learn."""

    def __init__(self, texts: list[str], precision: float = PRECISION):
        rows, labels, groups, addable = [], [], [], []
        ways = [0] * len(KINDS)
        for group, text in enumerate(texts):
            base = base_spans(text)
            of_kind = [_Cover(base[name]) for name in KINDS]
            every = _Cover(span for spans in base.values() for span in spans)
            found = []
            for c in candidates(text):
                kind, start, end = c
                # only what meets no base span may be added; over one of another kind it is a negative
                free = not every.meets(start, end)
                y = of_kind[kind].meets(start, end) or (free and _evident(text, *c))
                if y or not free or not _cued(text, *c) or _DATE.fullmatch(text[start:end]):
                    found.append((text, c, y, free))
            for kind, name in enumerate(KINDS):
                for start, end in base[name]:
                    wide, a, b = rewritten(text, kind, start, end, ways[kind])
                    ways[kind] += 1
                    own = _Cover(base_spans(wide)[name])
                    found += [(wide, c, True, True) for c in candidates(wide)
                              if c[0] == kind and c[1] < b and a < c[2] and not own.meets(c[1], c[2])]
            for t, c, y, free in found:
                rows.append(features(t, *c))
                labels.append(y)
                groups.append(group)
                addable.append(free)
        self.trees, self.thresholds = None, np.full(len(KINDS), np.inf)
        y = np.asarray(labels, float)
        if len(rows) >= 40 and 0 < y.sum() < len(y):
            x = np.asarray(rows, float)
            group = np.unique(groups, return_inverse=True)[1]  # a text's rows are held out together
            held = (group if group.max() >= 8 else np.arange(len(y))) % 4 == 0
            self.trees = BoostedTrees().fit(x[~held], y[~held])
            held = held & np.asarray(addable)
            score = self.trees.predict(x[held])
            for kind in range(len(KINDS)):
                own = x[held][:, 0] == kind
                self.thresholds[kind] = calibrated_threshold(score[own], y[held][own], precision)

    def added(self, text: str, base: dict[str, list[tuple[int, int]]]) -> list[tuple[int, int, int]]:
        """Candidates above their kind's threshold that meet no base span of any kind, the best first, none twice."""
        if self.trees is None:
            return []
        every = _Cover(span for spans in base.values() for span in spans)
        open_ = [c for c in candidates(text) if not every.meets(c[1], c[2])]
        if not open_:
            return []
        score = self.trees.predict(np.asarray([features(text, *c) for c in open_], float))
        kinds = np.asarray([c[0] for c in open_])
        taken, out = _Cover(), []
        for i in sorted(np.flatnonzero(score >= self.thresholds[kinds]), key=lambda i: (-score[i], open_[i])):
            kind, start, end = open_[i]
            if not taken.meets(start, end):
                taken.add(start, end)
                out.append((kind, start, end))
        return out


def _joined(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k]))


def train(docs: DataFrame, max_docs: int = TRAIN_DOCS, precision: float = PRECISION) -> Model:
    """Fit on a sample of at most ``max_docs`` texts that hold a digit or an @ sign."""
    hold = docs.select("text").where(F.col("text").rlike("[0-9@]"))
    share = min(1.0, 1.2 * max_docs / max(docs.count(), 1))
    texts = [r["text"] for r in hold.sample(False, share, TRAIN_SEED).limit(max_docs).toLocalIterator()]
    return Model(texts, precision)


def find(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The counts and the hash are of the base spans; ``spans`` lists base and
    added ones.  Null texts are empty.  Repeated rows and null ids give a row
    each; empty table: no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                base = base_spans(text)
                added = trees.added(text, base)
                own = _joined(base)
                every = _joined({k: base[k] + [(a, b) for kind, a, b in added if KINDS[kind] == k] for k in KINDS}) if added else own
                rows.append((doc_id, *[len(base[k]) for k in KINDS], hashlib.sha256(own.encode()).hexdigest(), every, len(added)))
            cols = list(zip(*rows)) or [[]] * 8
            types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with each span's characters replaced by its kind in brackets; doc_id must be unique.

    Spans that overlap are replaced as one stretch that names the kinds of all of them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("_spans").to_pylist()):
                stretches: list[list] = []
                for kind, a, b in sorted((s.split(":") for s in (spans or "").split(",") if s),
                                         key=lambda s: (int(s[1]), int(s[2]))):
                    if stretches and int(a) < stretches[-1][1]:
                        stretches[-1][1] = max(stretches[-1][1], int(b))
                        stretches[-1][2].append(kind)
                    else:
                        stretches.append([int(a), int(b), [kind]])
                parts, last = [], 0
                for a, b, kinds in stretches:
                    parts += [text[last:a], f"[{'+'.join(dict.fromkeys(kinds))}]"]
                    last = b
                out.append(None if text is None else "".join(parts) + text[last:])
            names = batch.schema.names
            cols = [pa.array(out, pa.string()) if c == "text" else batch.column(c) for c in names if c != "_spans"]
            yield pa.RecordBatch.from_arrays(cols, names=[c for c in names if c != "_spans"])

    side = found.select(F.col("doc_id").alias("_id"), F.col("spans").alias("_spans"))
    joined = docs.join(side, docs["doc_id"] == side["_id"], "left").drop("_id")
    return joined.mapInArrow(run, docs.schema)
