"""Personal data by weak supervision.

Candidates are the matches of four base patterns (email, ip, card, phone),
the base matches that fail their check, and looser spellings of the same
kinds. Four labelers vote on each candidate (yes, no, or nothing): the strict
pattern with its check, gazetteers (top-level domains, calling codes, card
issuers, address ranges), cue words before the candidate, and its shape.
Expectation-maximisation over the counted vote patterns estimates how
reliable each labeler is and how likely each pattern is real. Those
probabilities train the final span classifier, a logistic regression on the
votes and on the candidate's surroundings. It adds spans; valid base matches
always stay.

Two passes over the texts, no text is shuffled: the first counts patterns of
votes and features per task (the domain of patterns is fixed, a few thousand
at most, and that is all the driver gets), the second writes the spans.

Defined results: NULL and empty texts have no span; an added span never
overlaps a base span or an earlier added one; repeated rows are scanned one
by one; an empty table gives an empty result (and a model that adds nothing);
other columns are not read. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimledger.llm.common import relation

KINDS = ("email", "ip", "card", "phone")
YES, NO, NONE = 1, 0, 2
LABELERS = ("pattern", "gazetteer", "context", "shape")
FEATURES = ("kind", "origin", "digits", "left", "right")
ADD_FROM = 0.8        # probability from which the classifier adds a span
CONTEXT = 40          # characters before a candidate that are searched for cues

# Gazetteers.
DOMAINS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu us ca ch at be se no dk fi pl "
                    "pt br mx ar cn jp kr in au nz ru example".split())
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 "
                          "62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 351 352 353 354 355 358 359 370 371 372 "
                          "380 385 386 420 421".split())
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|30|36|38|6011|65|35|62")
CUES = {
    "email": frozenset("email mail e-mail contact write correo courriel kontakt reach address adresse".split()),
    "ip": frozenset("ip host server address adresse login from client gateway".split()),
    "card": frozenset("card visa mastercard amex credit debit tarjeta carte karte kreditkarte payment".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax whatsapp telefon handy teléfono móvil".split()),
}
DOUBTS = frozenset("version v release isbn issn doi id order invoice ref section page build serial sku token key "
                   "hash checksum".split())

EMAIL_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The digit before is ruled out only to skip starts inside a run of digits;
# a run either matches from its start or not at all.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
LOOSE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?[(\[](?:at|AT)[)\]]\x20?[A-Za-z0-9-]+"
                        r"(?:\x20?(?:\.|[(\[](?:dot|DOT)[)\]])\x20?[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}(?![0-9.])"),
    "card": re.compile(r"(?<![0-9.])[0-9]{4}(?:\.[0-9]{4}){3}(?![0-9.])"),
    "phone": re.compile(r"(?<![0-9+.()-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.-][0-9]{4}(?![0-9-])"),
}
WORD = re.compile(r"[^\W\d_][\w-]*")


@dataclass(frozen=True)
class Candidate:
    kind: str
    start: int
    end: int
    origin: str          # base, failed, part or loose


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d)
        if i % 2:
            x = x * 2 - 9 if x > 4 else x * 2
        total += x
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int, bool]]:
    """The pattern needs a local part before and a host after an @; both are
    found from the @, which keeps the search linear."""
    local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in local:
            start -= 1
        host = EMAIL_HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end(), True
        floor = host.end() if host else at + 1
        at = text.find("@", floor)


def base_matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, valid) of the base patterns, leftmost and not
    overlapping per kind."""
    for start, end, ok in _emails(text):
        yield "email", start, end, ok
    if not DIGITS.search(text):
        return
    for m in IP.finditer(text):
        yield "ip", m.start(), m.end(), all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m[0].split("."))
    for m in CARD.finditer(text):
        digits = "".join(DIGITS.findall(m[0]))
        if len(digits) >= 10:
            yield "card", m.start(), m.end(), 14 <= len(digits) <= 19 and luhn(digits)
    for m in PHONE.finditer(text):
        yield "phone", m.start(), m.end(), 10 <= sum(map(len, DIGITS.findall(m[0]))) <= 15


def _phone_part(text: str, start: int, end: int) -> int:
    """End of the longest run of whole digit groups with 10 to 15 digits."""
    count, best = 0, 0
    for group in DIGITS.finditer(text, start, end):
        count += len(group[0])
        if count > 15:
            break
        if count >= 10:
            best = group.end()
    return best


def candidates(text: str) -> list[Candidate]:
    """All candidates; valid base matches first."""
    valid, others = [], []
    for kind, start, end, ok in base_matches(text):
        if ok:
            valid.append(Candidate(kind, start, end, "base"))
            continue
        part = _phone_part(text, start, end) if kind == "phone" else 0
        others.append(Candidate(kind, start, part, "part") if part else Candidate(kind, start, end, "failed"))
    for kind, pattern in LOOSE.items():
        if kind == "email" and "(at)" not in (low := text.lower()) and "[at]" not in low:
            continue
        others += [Candidate(kind, m.start(), m.end(), "loose") for m in pattern.finditer(text)]
    return valid + others


def votes(text: str, c: Candidate) -> tuple[int, ...]:
    """A vote of each labeler."""
    found = text[c.start:c.end]
    groups = DIGITS.findall(found)
    digits = "".join(groups)
    pattern = {"base": YES, "failed": NO}.get(c.origin, NONE)
    if c.kind == "email":
        gazetteer = YES if re.split(r"[.\x20()\[\]]+", found.rstrip(")]").lower())[-1] in DOMAINS else NO
        shape = NO if ".." in found or found[0] in ".-%+" else YES
    elif c.kind == "ip":
        first = int(groups[0][:4])
        gazetteer = YES if 0 < first < 224 and first != 127 else NO
        shape = NO if any(len(g) > 1 and g[0] == "0" or len(g) > 3 for g in groups[:4]) else YES
    elif c.kind == "card":
        gazetteer = YES if ISSUERS.match(digits) else NO
        sizes = [len(g) for g in groups]
        shape = YES if sizes in ([4, 4, 4, 4], [4, 6, 5], [16], [15]) and luhn(digits) else (
            NO if not luhn(digits) else NONE)
    else:
        code = any(digits.startswith(x) for x in CALLING_CODES) if found[0] == "+" else None
        gazetteer = NONE if code is None else YES if code else NO
        shape = YES if 3 <= len(groups) <= 6 and max(map(len, groups)) <= 5 else NO
    cues = {w.lower() for w in WORD.findall(text, max(0, c.start - CONTEXT), c.start)}
    context = NO if cues & DOUBTS else YES if cues & CUES[c.kind] else NONE
    return pattern, gazetteer, context, shape


def _side(char: str) -> str:
    if not char or char.isspace():
        return "space"
    return "alnum" if char.isalnum() else "mark"


def features(text: str, c: Candidate) -> tuple[str, ...]:
    digits = sum(map(len, DIGITS.findall(text[c.start:c.end])))
    size = "0" if not digits else "1-9" if digits < 10 else "10-13" if digits < 14 else "14-19" if digits < 20 else "20+"
    return (c.kind, c.origin, size, _side(text[c.start - 1:c.start] if c.start else ""), _side(text[c.end:c.end + 1]))


# ------------------------------------------------------------------ learning

@dataclass
class SpanModel:
    reliability: np.ndarray             # labeler x truth x vote
    weights: dict[str, float]
    bias: float

    def probability(self, vote: tuple[int, ...], feature: tuple[str, ...]) -> float:
        z = self.bias + sum(self.weights.get(n, 0.0) for n in _names(vote, feature))
        return 1 / (1 + np.exp(-z))


def _names(vote: tuple[int, ...], feature: tuple[str, ...]) -> list[str]:
    kind = feature[0]
    return ([f"{n}={v}" for n, v in zip(LABELERS, vote, strict=True)]
            + [f"{kind}:{n}={v}" for n, v in zip(FEATURES, feature, strict=True)])


def estimate(vote_rows: np.ndarray, kinds: np.ndarray, counts: np.ndarray, rounds: int = 50
             ) -> tuple[np.ndarray, np.ndarray]:
    """EM over counted vote patterns: reliabilities (labeler x truth x vote)
    and the probability of each pattern to be real. Starts from the majority."""
    ups, downs = (vote_rows == YES).sum(axis=1), (vote_rows == NO).sum(axis=1)
    real = np.clip(0.5 + 0.4 * np.sign(ups - downs), 0.1, 0.9)
    table = np.zeros((vote_rows.shape[1], 2, 3))
    for _ in range(rounds):
        mass = np.stack([(1 - real) * counts, real * counts])
        for j in range(vote_rows.shape[1]):
            for v in (NO, YES, NONE):
                table[j, :, v] = mass[:, vote_rows[:, j] == v].sum(axis=1) + 1.0
        table /= table.sum(axis=2, keepdims=True)
        log = np.zeros((2, len(real)))
        for k in np.unique(kinds):
            own = kinds == k
            log[:, own] = np.log((mass[:, own].sum(axis=1, keepdims=True) + 1.0) / (mass[:, own].sum() + 2.0))
        for j in range(vote_rows.shape[1]):
            log += np.log(table[j][:, vote_rows[:, j]])
        real = 1 / (1 + np.exp(np.clip(log[0] - log[1], -35, 35)))
    return table, real


def train(patterns: list[tuple[tuple[int, ...], tuple[str, ...], int]]) -> SpanModel:
    """Reliabilities by EM, then a logistic regression on the probabilities."""
    if not patterns:
        return SpanModel(np.zeros((len(LABELERS), 2, 3)), {}, -10.0)
    patterns = sorted(patterns)
    rows = np.array([p[0] for p in patterns])
    kinds = np.array([p[1][0] for p in patterns])
    counts = np.array([p[2] for p in patterns], dtype=np.float64)
    table, real = estimate(rows, kinds, counts)
    names = [_names(v, f) for v, f, _ in patterns]
    index = {n: i for i, n in enumerate(sorted({n for row in names for n in row}))}
    x = np.zeros((len(patterns), len(index) + 1))
    x[:, -1] = 1
    for i, row in enumerate(names):
        x[i, [index[n] for n in row]] = 1
    w, share = np.zeros(x.shape[1]), counts / counts.sum()
    penalty = np.full(x.shape[1], 1e-4)
    for _ in range(30):                                  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        slope = x.T @ (share * (p - real)) + penalty * w
        curve = (x * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        w -= np.linalg.solve(curve, slope)
    return SpanModel(table, {n: float(w[i]) for n, i in index.items()}, float(w[-1]))


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            counts.update((votes(text, c), features(text, c)) for c in candidates(text or ""))
    yield pa.RecordBatch.from_arrays(
        [pa.array([list(v) for v, _ in counts], pa.list_(pa.int32())),
         pa.array([list(f) for _, f in counts], pa.list_(pa.string())),
         pa.array(list(counts.values()), pa.int64())], names=["votes", "features", "n"])


def learn(docs: DataFrame, text_col: str = "text") -> SpanModel:
    counted = (docs.select(F.col(text_col).alias("text"))
               .mapInArrow(_patterns, "votes array<int>, features array<string>, n long")
               .groupBy("votes", "features").agg(F.sum("n").alias("n")).collect())
    return train([(tuple(r["votes"]), tuple(r["features"]), r["n"]) for r in counted])


# ------------------------------------------------------------------ spans

def spans_of(text: str, model: SpanModel, add_from: float = ADD_FROM) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) in the order of start, then kind as listed."""
    found = candidates(text)
    spans = [(c.kind, c.start, c.end, True) for c in found if c.origin == "base"]
    taken = sorted((s, e) for _, s, e, _ in spans)
    starts, ends, reach = [s for s, _ in taken], [], 0
    for _, e in taken:                      # furthest end so far, for overlaps across kinds
        reach = max(reach, e)
        ends.append(reach)
    last = 0
    for c in sorted((c for c in found if c.origin != "base"), key=lambda c: (c.start, KINDS.index(c.kind))):
        i = bisect_left(starts, c.end)
        if c.start < last or (i and ends[i - 1] > c.start):
            continue
        if model.probability(votes(text, c), features(text, c)) >= add_from:
            spans.append((c.kind, c.start, c.end, False))
            last = c.end
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def personal_data(docs: DataFrame, model: SpanModel | None = None, add_from: float = ADD_FROM,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its spans (kind, start, end, base); learns from ``docs``
    where no model is given."""
    model = learn(docs, text_col) if model is None else model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in spans_of(t or "", model, add_from)]
                    for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, SPANS)], names=["doc_id", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")


def op9_personal_data(spark, sf_dir):
    found = personal_data(relation(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id", *[count(kind) for kind in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


QUERIES = {"op9_personal_data": op9_personal_data}
ORACLE = {}
