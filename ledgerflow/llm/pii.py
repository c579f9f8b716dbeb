r"""Personal data by weak supervision.

Base spans come from the fixed patterns of :func:`base_spans`. What the patterns don't
cover is proposed as a candidate (long codes, grouped numbers, names after a
cue); labelers vote on each candidate or abstain: shape regexes, gazetteers (key
words, given names) and context cues. Expectation-maximisation over the counts of
vote patterns (3^labelers at most, whatever the corpus's size) estimates the class
share and each labeler's reliability (Dawid and Skene). The posteriors then train the
final span classifier, a logistic model over the candidate's binned features, again
from counts. Candidates that it gives ``ACCEPT`` or more are added; base spans stay.

Defined results: null text counts as empty and has no spans; positions are code
points, the end exclusive; very long texts are scanned whole, in time linear in their
length; a corpus without candidates adds no span; an empty table gives no rows.
"""
from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import tidy

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("id_number", "name", "secret")
ACCEPT = 0.9
EM_ROUNDS = 50

# The base patterns. A match never starts inside a run of the characters
# that its first part takes, so looking behind for one gives the same matches in linear time.
_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0  # where the last match ended
    for m in _AT.finditer(text):
        at = start = m.start()
        while start > free and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        if start < at:
            yield start, m.end()
            free = m.end()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not any(c in text for c in "0123456789"):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 40 and 16 <= len(digits := _NOT_DIGIT.sub("", m.group())) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# Gazetteers and cues.
SECRET_CUES = {"token", "secret", "password", "passwd", "passphrase", "key", "apikey", "api_key", "access_key", "private_key", "auth",
               "bearer", "credential", "credentials", "pwd", "passwort", "contrasena"}
ID_CUES = {"ssn", "passport", "iban", "account", "id", "tax", "licence", "license", "social", "insurance", "policy", "badge", "employee",
           "customer", "member", "konto", "ausweis", "steuer", "compte", "passeport", "cuenta", "pasaporte", "dni"}
NAME_CUES = {"mr", "mrs", "ms", "dr", "herr", "frau", "monsieur", "madame", "senor", "senora", "name"}
GIVEN_NAMES = {
    "adam", "alan", "alejandro", "alexander", "alice", "amy", "ana", "andrea", "andrew", "angela", "anna", "anne", "antoine", "antonio",
    "barbara", "ben", "benjamin", "brian", "camille", "carl", "carlos", "carmen", "carol", "charles", "charlotte", "chloe", "christian",
    "christine", "claire", "claudia", "daniel", "david", "diego", "donald", "edward", "elena", "elizabeth", "emily", "emma", "eric",
    "eva", "fernando", "francisco", "frank", "franz", "fritz", "george", "hans", "heinrich", "helen", "henry", "isabel", "jack",
    "jacques", "james", "jan", "jane", "javier", "jean", "jennifer", "johanna", "john", "jose", "joseph", "juan", "julia", "julie",
    "karen", "karl", "katharina", "kevin", "klaus", "laura", "leon", "linda", "lisa", "louis", "lucas", "lucia", "luis", "manuel",
    "marc", "margaret", "maria", "marie", "mark", "marta", "martin", "mary", "matthew", "michael", "miguel", "monica", "nancy",
    "nicolas", "nina", "olivia", "pablo", "patricia", "paul", "paula", "pedro", "peter", "philip", "pierre", "rachel", "richard",
    "robert", "rosa", "ruth", "sandra", "sarah", "sofia", "sophie", "stefan", "stephen", "steven", "susan", "thomas", "ursula",
    "valerie", "victor", "walter", "werner", "william", "wolfgang"}
_CODE = re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{20,}+")
_GROUPED = re.compile(r"(?<![0-9A-Za-z.-])[0-9]{2,6}+(?:-[0-9]{2,6}+){1,4}(?![0-9A-Za-z-])")
_NAMED = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Monsieur|Madame|Senora?|[Nn]ame is|[Nn]ame:)\.? "
                    r"([A-Z][a-z]{1,30}(?: [A-Z][a-z]{1,30})?)")
_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_CUE = re.compile(r"([A-Za-z_]+)[^A-Za-z_]{0,4}$")
LABELERS = ("shape_secret", "shape_id", "cue_secret", "cue_id", "cue_name", "gazetteer_name", "quoted", "assigned",
            "plain_words")


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, str, str]]:
    """(kind, start, end, votes, features) of what the base patterns leave."""
    found = []
    if any(c in text for c in "0123456789"):
        found += [("secret", m.start(), m.end()) for m in _CODE.finditer(text)]
        found += [("id_number", m.start(), m.end()) for m in _GROUPED.finditer(text)]
    found += [("name", m.start(1), m.end(1)) for m in _NAMED.finditer(text)]
    out, free, starts, ends = [], 0, *_merged(base)
    for kind, a, b in sorted(found, key=lambda x: (x[1], -x[2], x[0])):
        near = bisect_left(starts, b)  # base spans that begin before b: the last of them reaches furthest
        if a < free or near and ends[near - 1] > a:
            continue
        free = b
        out.append((kind, a, b, *_judge(kind, text, a, b)))
    return out


def _merged(base: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the base spans, those that overlap as one."""
    starts, ends = [], []
    for a, b in sorted((a, b) for _, a, b in base):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def _judge(kind: str, text: str, a: int, b: int) -> tuple[str, str]:
    """Votes ('+', '-' or '.' per labeler) and binned features of one candidate."""
    span, before, after = text[a:b], text[max(0, a - 24):a], text[b:b + 1]
    cue = _CUE.search(before)
    cue = cue.group(1).lower() if cue else ""
    digits = sum(c.isdigit() for c in span)
    mixed = 0.2 <= digits / len(span) <= 0.9
    quoted = before[-1:] in "\"'" and before[-1:] != "" and after == before[-1:]
    assigned = bool(re.search(r"[=:]\s*[\"']?$", before))
    sign = lambda yes, no: "+" if yes else "-" if no else "."
    votes = {
        "shape_secret": sign(kind == "secret" and mixed and bool(_HEX.fullmatch(span)), kind == "secret" and not mixed),
        "shape_id": sign(kind == "id_number" and bool(re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", span)),
                         kind == "id_number" and bool(re.fullmatch(r"(?:19|20)[0-9]{2}-[0-9]{2}(?:-[0-9]{2})?", span))),
        "cue_secret": sign(kind == "secret" and cue in SECRET_CUES, kind == "secret" and not cue),
        "cue_id": sign(kind == "id_number" and cue in ID_CUES, kind == "id_number" and cue not in ID_CUES),
        "cue_name": sign(kind == "name" and cue in NAME_CUES, False),
        "gazetteer_name": sign(kind == "name" and span.split(" ")[0].lower() in GIVEN_NAMES, kind == "name"),
        "quoted": sign(quoted, kind == "id_number"),
        "assigned": sign(assigned, kind == "id_number"),
        "plain_words": sign(False, kind == "secret" and "-" in span and digits < 4),
    }
    bins = (kind, f"len{min(8, len(span) // 8)}", f"digits{min(4, int(5 * digits / len(span)))}", f"quoted{int(quoted)}",
            f"assigned{int(assigned)}", f"hex{int(bool(_HEX.fullmatch(span)))}",
            f"cue{int(cue in SECRET_CUES | ID_CUES | NAME_CUES)}")
    return "".join(votes[x] for x in LABELERS), " ".join(bins)


def em(patterns: dict[str, int], rounds: int = EM_ROUNDS) -> tuple[dict[str, float], float, np.ndarray]:
    """Posterior of each vote pattern, class share, and reliabilities
    [class, labeler, vote (abstain, for, against)] from pattern counts."""
    names = sorted(patterns)
    n = np.array([patterns[p] for p in names], float)
    votes = np.array([[".+-".index(v) for v in p] for p in names]).reshape(len(names), -1)
    ups, downs = (votes == 1).sum(1), (votes == 2).sum(1)
    post = (ups + 0.5) / (ups + downs + 1)  # start: the majority
    rely = np.zeros((2, votes.shape[1], 3))
    share = 0.5
    for _ in range(rounds):
        share = float(np.clip((n * post).sum() / n.sum(), 1e-3, 1 - 1e-3))
        for c, weight in ((1, n * post), (0, n * (1 - post))):
            for v in range(3):
                rely[c, :, v] = ((votes == v) * weight[:, None]).sum(0) + 1.0
            rely[c] /= rely[c].sum(1, keepdims=True)
        at = np.arange(votes.shape[1])
        logit = np.log(share / (1 - share)) + (np.log(rely[1][at, votes]) - np.log(rely[0][at, votes])).sum(1)
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return dict(zip(names, post.tolist())), share, rely


def train(counts: list[tuple[str, str, int]], posterior: dict[str, float], steps: int = 500) -> dict[str, float]:
    """Weights of the span classifier from (votes, features, count); '' is the intercept."""
    rows = [(["", *f.split(" ")], posterior[v], n) for v, f, n in counts]
    names = sorted({x for fs, _, _ in rows for x in fs})
    at = {f: k for k, f in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for k, (fs, _, _) in enumerate(rows):
        x[k, [at[f] for f in fs]] = 1
    y, n = np.array([r[1] for r in rows]), np.array([r[2] for r in rows], float)
    w, n = np.zeros(len(names)), n / n.sum()
    for _ in range(steps):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (p - y)) + 1e-4 * w
        if np.abs(grad).max() < 1e-9:
            break
        h = (x * (n * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(names))
        w = w - np.linalg.solve(h, grad)
    return dict(zip(names, w.tolist()))


def probability(weights: dict[str, float], features: str) -> float:
    z = weights.get("", 0.0) + sum(weights.get(f, 0.0) for f in features.split(" "))
    return 1 / (1 + float(np.exp(-np.clip(z, -30, 30))))


def learn(docs: DataFrame) -> dict[str, float]:
    """The classifier's weights from all documents' candidates; {} without any."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for t in batch.column("text").to_pylist():
                seen.update(c[3:] for c in candidates(t or "", base_spans(t or "")))
            keys = sorted(seen)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array(
                [k[1] for k in keys], pa.string()), pa.array([seen[k] for k in keys], pa.int64())],
                ["votes", "features", "n"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(tidy(task), "votes string, features string, n long")
    # as many rows as there are vote patterns and feature bins, whatever the corpus's size
    counts = [tuple(r) for r in rows.groupBy("votes", "features").agg(F.sum("n").alias("n")).orderBy(
        "votes", "features").collect()]
    if not counts:
        return {}
    patterns: Counter = Counter()
    for v, _, n in counts:
        patterns[v] += n
    posterior, _, _ = em(patterns)
    return train(counts, posterior)


def spans(text: str, weights: dict[str, float], accept: float = ACCEPT) -> list[tuple[str, int, int]]:
    """Base spans, and the candidates that the classifier accepts, by kind and start."""
    base = base_spans(text)
    more = [(k, a, b) for k, a, b, _, f in candidates(text, base) if weights and probability(weights, f) >= accept]
    return base + sorted(more, key=lambda s: (KINDS.index(s[0]), s[1]))


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def find(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *[T.StructField(f"n_{k}", T.LongType()) for k in BASE_KINDS],
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans(t or "", weights) for t in batch.column("text").to_pylist()]
            n = [Counter(s[0] for s in f) for f in found]
            base = [joined([s for s in f if s[0] in BASE_KINDS]) for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([c[k] for c in n], pa.int64()) for k in BASE_KINDS],
                 pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                 pa.array([joined(f) for f in found], pa.string())], [f.name for f in schema.fields])

    return rows.mapInArrow(tidy(task), schema)


def mask(text: str, found: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; where spans
    overlap, one mask of the first kind covers them."""
    out, at, last = [], 0, 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
        if a >= last:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = last = max(last, b)
    return "".join(out) + text[at:]


def masked(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``docs`` with every span of ``text`` masked and ``n_chars`` (if there) counted anew."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            new = [t if t is None or not (f := spans(t, weights)) else mask(t, f) for t in texts]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    out = docs.mapInArrow(tidy(task), docs.schema)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else out
