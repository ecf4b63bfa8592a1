"""Personal data by weak supervision.

Loose patterns give candidate spans. Labelers vote on each: the strict patterns, gazetteers of mail endings,
of reserved networks and of card issuers, and the words around the span. Expectation-maximisation over
the counts of equal vote patterns estimates how reliable each labeler is; its posteriors train a logistic
span classifier on the counted feature patterns. The candidates of the strict patterns always stay; of the
others, those remain that the classifier accepts.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lealtia.llm.common import stored

KINDS = ["email", "ip", "card", "phone"]
#: Share of posterior mass from which a further span is accepted.
ACCEPT = 0.5
ROUNDS = 50
#: Characters read on each side of a candidate for the context labelers.
CONTEXT = 32

# The strict patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# An address is four numbers; runs of numbers with a point between neighbours hold them one after the other.
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Loose patterns: what the strict ones leave out. The one for mail begins at the sign; the local part is before it.
LOOSE = [
    ("email", re.compile(r" ?(?:(?:\(at\)|\[at\]) ?[A-Za-z0-9-]+(?: ?(?:\(dot\)|\[dot\]| dot |\.) ?[A-Za-z0-9-]+)+"
        r"| at [A-Za-z0-9-]+(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]+)+)")),
    ("ip", re.compile(r"\b(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}\b")),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20./-][0-9]{4}){3}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9+.])(?:\(0[0-9]{1,4}\)|0[0-9]{1,4})[\x20/-][0-9][\x20/0-9-]{4,}[0-9](?![0-9.])")),
]
#: Without one of these no loose mail address can match, so most texts are spared its search.
MASKS = ("(at)", "[at]", " dot ", "(dot)", "[dot]")

# Gazetteers.
ENDINGS = frozenset("com org net edu gov info io de fr es uk eu us".split())
CUES = {
    "email": ("mail", "contact", "write", "correo", "courriel", "kontakt"),
    "ip": ("ip", "host", "server", "address", "node"),
    "card": ("card", "visa", "credit", "tarjeta", "carte", "karte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "móvil"),
}
AGAINST = ("version", "isbn", "order", "invoice", "token", "id ", "no.", "figure")

SPANS = "array<struct<kind:string,start:int,end:int,strict:boolean,votes:string,features:string>>"
LABELERS = ["strict", "gazetteer", "cue", "against", "shape"]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def strict_emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``EMAIL``, sought from the sign outwards: the local part cannot hold a sign itself."""
    last = 0
    for match in AT.finditer(text):
        start = match.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < match.start():
            yield start, match.end()
            last = match.end()


def strict_addresses(text: str) -> Iterator[tuple[int, int]]:
    """Runs of four numbers with points between, leftmost first, none of them above 255."""
    for match in NUMBERS.finditer(text):
        parts, start = match.group().split("."), match.start()
        for first in range(0, len(parts) - 3, 4):
            four = parts[first : first + 4]
            end = start + sum(map(len, four)) + 3
            bare = [part.lstrip("0") or "0" for part in four]
            if all(len(part) <= 3 and int(part) <= 255 for part in bare):
                yield start, end
            start = end + 1


def strict_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the strict patterns, by start and then kind."""
    found = [(s, e, 0) for s, e in strict_emails(text)] if "@" in text else []
    found += [(s, e, 1) for s, e in strict_addresses(text)]
    for match in CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((match.start(), match.end(), 2))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in match.group()) <= 15:
                found.append((match.start(), match.end(), 3))
    return [(s, e, KINDS[k]) for s, e, k in sorted(found, key=lambda f: (f[0], f[2]))]


def votes_of(text: str, start: int, end: int, kind: str, strict: bool) -> str:
    """A vote of each labeler: ``+``, ``-`` or ``0``."""
    span = text[start:end]
    before = text[max(0, start - CONTEXT) : start].lower()
    digits = re.sub(r"[^0-9]", "", span)
    if kind == "email":
        listed = "+" if re.split(r"[^A-Za-z0-9-]+", span.lower())[-1] in ENDINGS else "-"
    elif kind == "ip":
        first = span.split(".")[0]
        listed = "-" if first in ("0", "127", "255") else "+"
    elif kind == "card":
        listed = "+" if digits[:1] in "3456" and digits else "-"
    else:
        listed = "+" if span[0] in "+(0" else "-"
    cue = "+" if any(c in before for c in CUES[kind]) else "0"
    against = "-" if any(c in before for c in AGAINST) else "0"
    glued = (start > 0 and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    return ("+" if strict else "-") + listed + cue + against + ("-" if glued else "+")


def features_of(text: str, start: int, end: int, kind: str, votes: str) -> str:
    """The discrete features of a span: kind, votes of the weak labelers, number of digits and of separators."""
    span = text[start:end]
    n_digits = sum(c.isdigit() for c in span)
    marks = len(re.findall(r"[^A-Za-z0-9]", span))
    return f"{kind}|{votes[1:]}|{min(n_digits, 20) // 4}|{min(marks, 6) // 2}"


def loose_matches(text: str, kind: str, pattern: re.Pattern) -> Iterator[tuple[int, int]]:
    """Matches of a loose pattern; those of mail with the local part before their sign, and none without one."""
    last = 0
    for match in pattern.finditer(text):
        start = match.start()
        if kind == "email":
            while start > last and text[start - 1] in LOCAL:
                start -= 1
            if start == match.start():
                continue
        yield start, match.end()
        last = match.end()


def candidates(text: str) -> list[dict]:
    """All strict and loose spans of a whole text; loose ones do not overlap others of their kind."""
    masked = any(mark in text for mark in MASKS)
    if not masked and not any(c in text for c in "@0123456789"):
        return []
    spans = [(s, e, kind, True) for s, e, kind in strict_spans(text)]
    for kind, pattern in LOOSE:
        if kind == "email" and not masked or kind == "ip" and text.count(":") < 7:
            continue
        taken = [(s, e) for s, e, k, _ in spans if k == kind]
        for start, end in loose_matches(text, kind, pattern):
            # Spans of one kind do not overlap, so only the last one that begins before the end can be in the way.
            before = bisect.bisect_left(taken, (end,)) - 1
            if before < 0 or taken[before][1] <= start:
                spans.append((start, end, kind, False))
    rows = []
    for start, end, kind, strict in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))):
        votes = votes_of(text, start, end, kind, strict)
        rows.append(
            {
                "kind": kind,
                "start": start,
                "end": end,
                "strict": strict,
                "votes": votes,
                "features": features_of(text, start, end, kind, votes),
            }
        )
    return rows


def candidate_spans(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the candidate ``spans`` of every row."""
    kind = pa.struct(
        [
            ("kind", pa.string()),
            ("start", pa.int32()),
            ("end", pa.int32()),
            ("strict", pa.bool_()),
            ("votes", pa.string()),
            ("features", pa.string()),
        ]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [candidates(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(kind))], names=["doc_id", "spans"]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        rows, f"doc_id long, spans {SPANS}"
    )


def reliabilities(patterns: list[tuple[str, int]], rounds: int = ROUNDS) -> tuple[float, np.ndarray]:
    """Expectation-maximisation over (votes, count): the share of true spans and P(vote | class) per labeler.

    The result has the shape (class, labeler, vote) with the votes ``-``, ``0``, ``+``; class 1 is true.
    It starts from labelers that are right three times in four, which also names the classes.
    """
    votes = np.array([["-0+".index(v) for v in p] for p, _ in patterns])
    counts = np.array([n for _, n in patterns], float)
    n_labelers = votes.shape[1]
    share = 0.5
    table = np.tile(np.array([[[0.6, 0.2, 0.2]], [[0.2, 0.2, 0.6]]]), (1, n_labelers, 1))
    labelers = np.arange(n_labelers)
    for _ in range(rounds):
        posterior = posteriors(votes, share, table)
        share = float(np.clip((posterior * counts).sum() / counts.sum(), 0.01, 0.99))
        fresh = np.full_like(table, 0.5)
        for kind, weight in enumerate((counts * (1 - posterior), counts * posterior)):
            for column in labelers:
                np.add.at(fresh[kind, column], votes[:, column], weight)
        table = fresh / fresh.sum(axis=2, keepdims=True)
    return share, table


def posteriors(votes: np.ndarray, share: float, table: np.ndarray) -> np.ndarray:
    """P(true | votes) of each row of vote numbers."""
    labelers = np.arange(votes.shape[1])
    logs = [np.log(p) + np.log(table[kind, labelers, votes]).sum(axis=1) for kind, p in ((0, 1 - share), (1, share))]
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def design(features: list[str]) -> np.ndarray:
    """Indicator columns of feature patterns; every pattern has values from small fixed sets."""
    columns = {f"kind={k}": i for i, k in enumerate(KINDS)}
    names = ["gazetteer", "cue", "against", "shape"]
    for name in names:
        for vote in "-0+":
            columns[f"{name}={vote}"] = len(columns)
    for n in range(6):
        columns[f"digits={n}"] = len(columns)
    for n in range(4):
        columns[f"marks={n}"] = len(columns)
    matrix = np.zeros((len(features), len(columns) + 1))
    matrix[:, -1] = 1
    for row, pattern in enumerate(features):
        kind, votes, digits, marks = pattern.split("|")
        parts = [f"kind={kind}", *(f"{n}={v}" for n, v in zip(names, votes)), f"digits={digits}", f"marks={marks}"]
        for part in parts:
            matrix[row, columns[part]] = 1
    return matrix


def train_classifier(rows: list[tuple[str, float, int]], penalty: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Logistic weights from (features, mean posterior, count), by Newton steps."""
    matrix = design([f for f, _, _ in rows])
    target = np.array([p for _, p, _ in rows])
    counts = np.array([n for _, _, n in rows], float)
    counts = counts / counts.sum()
    weights = np.zeros(matrix.shape[1])
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-np.clip(matrix @ weights, -30, 30)))
        slope = matrix.T @ (counts * (chance - target)) + penalty * weights
        bend = (matrix * (counts * chance * (1 - chance))[:, None]).T @ matrix + penalty * np.eye(len(weights))
        weights = weights - np.linalg.solve(bend, slope)
    return weights


def personal_spans(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """``doc_id`` and ``spans`` of every row: the strict ones and those that the classifier accepts.

    Spans are code points, end exclusive, by start and then kind. A null or empty text has none. Repeated
    rows and rows without an id are treated row by row; extra columns are left out. An empty table gives no
    rows; a table without candidates trains nothing and accepts nothing. The vote and feature patterns
    have a fixed number of values, so only their counts reach the driver.
    """
    found = stored(candidate_spans(docs), "pii-candidates")
    patterns = (
        found.select(F.explode("spans").alias("s"))
        .groupBy(F.col("s.votes").alias("votes"), F.col("s.features").alias("features"))
        .agg(F.count("*").alias("n"))
        .orderBy("votes", "features")
        .collect()
    )
    accepted: list[str] = []
    if patterns:
        share, table = reliabilities([(r["votes"], r["n"]) for r in patterns])
        votes = np.array([["-0+".index(v) for v in r["votes"]] for r in patterns])
        chance = posteriors(votes, share, table)
        weights = train_classifier([(r["features"], float(p), r["n"]) for r, p in zip(patterns, chance)])
        names = sorted({r["features"] for r in patterns})
        accepted = [n for n, z in zip(names, design(names) @ weights) if 1 / (1 + np.exp(-z)) >= accept]
    taken = F.array(*[F.lit(n) for n in accepted]).cast("array<string>")
    return found.select(
        "doc_id",
        F.filter("spans", lambda s: s["strict"] | F.array_contains(taken, s["features"])).alias("spans"),
    )
