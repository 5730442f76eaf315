"""Personal data by weak supervision.

Candidates are spans of four kinds. Labelers - patterns and checksums, gazetteers, the words around - vote for or against
each candidate or abstain. How often each combination of votes occurs is counted over all documents; from these counts
expectation-maximisation estimates how reliable each labeler is, and the resulting probabilities train a classifier on
the span's votes and form, which decides. Spans that satisfy the base definition stay in any case.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areastats.llm.common import materialise

KINDS = ("email", "ip", "card", "phone")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Forms beyond the base: a written-out address, and a number without its country code.
SPELT = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(] ?(?:at|AT) ?[\])] ?[A-Za-z0-9-]{1,63}(?:(?:\.| ?[\[(] ?(?:dot|DOT) ?[\])] ?)[A-Za-z0-9-]{1,63}){1,4}")
SPELT_MARK = re.compile(r"[\[(] ?(?:at|AT)")
LOCAL_PHONE = re.compile(r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9.-])")
DIGIT = re.compile(r"[0-9]")

#: Gazetteers (fixed values).
DOMAINS = frozenset(["com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "it", "uk", "eu", "us"])
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65")
COUNTRY_CODES = ("1", "33", "34", "39", "44", "49", "7", "81", "86", "91")
#: Context words (fixed values).
FOR = {
    "email": ("mail", "contact", "write", "schreib", "correo", "courriel"),
    "ip": ("ip", "server", "host", "address", "adresse"),
    "card": ("card", "visa", "pay", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "fax", "mobile", "handy"),
}
AGAINST = ("version", "token", "isbn", "hash", "sha", "commit", "build", "serial", "invoice", "order")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int, bool]]:
    """Leftmost matches: the run of local characters before each @, as far as the match before, and the domain after."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            done = domain.end()
            yield begin, done, True
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, base) of every candidate, by kind and start. Candidates of a kind do not overlap."""
    found: list[list[tuple[int, int, bool]]] = [list(emails(text)), [], [], []]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            found[1].append((*m.span(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19:
                found[2].append((*m.span(), luhn(digits)))
        for m in PHONE.finditer(text):
            digits = sum(c.isdigit() for c in m[0])
            if 9 <= digits <= 15:
                found[3].append((*m.span(), True))
    for kind, form, mark in ((0, SPELT, SPELT_MARK), (3, LOCAL_PHONE, DIGIT)):
        if mark.search(text):
            held, ends = found[kind], [b for _, b, _ in found[kind]]
            for m in form.finditer(text):
                i = bisect_right(ends, m.start())
                if i == len(ends) or held[i][0] >= m.end():
                    held.append((*m.span(), False))
    return [(k, a, b, base) for k, own in enumerate(found) for a, b, base in sorted(own)]


LABELERS = ("form", "gazetteer", "context", "setting")


def votes(text: str, kind: int, start: int, end: int, base: bool) -> tuple[int, ...]:
    """1 for, -1 against, 0 abstains; one for each labeler."""
    span = text[start:end]
    before = text[max(0, start - 40) : start].lower()
    name = KINDS[kind]
    digits = "".join(c for c in span if c.isdigit())
    if kind == 0:
        known = re.split(r"[^A-Za-z0-9]+", span)[-1].lower() in DOMAINS
    elif kind == 1:
        known = not span.startswith(("0.", "255.")) and len(digits) >= 5
    elif kind == 2:
        known = digits.startswith(ISSUERS)
    else:
        known = digits.startswith(COUNTRY_CODES) if span.startswith("+") else digits[0] not in "01"
    context = -1 if any(w in before for w in AGAINST) else 1 if any(w in before for w in FOR[name]) else 0
    edge = (start == 0 or not text[start - 1].isalnum()) and (end == len(text) or not text[end].isalnum())
    return (1 if base else -1, 1 if known else (-1 if kind != 1 else 0), context, 1 if edge else -1)


def spans(docs: DataFrame) -> DataFrame:
    """doc_id and its candidates: array of (kind, start, end, base, votes as digits 0 to 2, form feature). Whole texts; null is empty."""
    kind = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_()), ("code", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py() or ""
                own = []
                for k, a, b, base in candidates(text):
                    v = votes(text, k, a, b, base)
                    own.append({"kind": k, "start": a, "stop": b, "base": base, "code": pack(k, v)})
                rows.append(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, type=pa.list_(kind))], names=["doc_id", "found"])

    two = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return two.mapInArrow(run, "doc_id long, found array<struct<kind: int, start: long, stop: long, base: boolean, code: int>>")


def pack(kind: int, v: tuple[int, ...]) -> int:
    code = kind
    for x in v:
        code = code * 3 + x + 1
    return code


def unpack(code: int) -> tuple[int, np.ndarray]:
    v = []
    for _ in LABELERS:
        code, x = divmod(code, 3)
        v.append(x - 1)
    return code, np.array(v[::-1])


def reliabilities(v: np.ndarray, n: np.ndarray, steps: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """EM for independent labelers: (posterior of each vote row, accuracy of each labeler, share of true spans).

    `v` holds vote combinations in -1, 0, 1 and `n` how often each occurs. It starts from the majority; an accuracy is
    the share of a labeler's votes that agree with the truth, smoothed by one right and one wrong vote in ten.
    """
    p = np.clip(0.5 + 0.4 * np.sign(v.sum(axis=1)), 0.05, 0.95)
    right, prior = np.full(v.shape[1], 0.8), 0.5
    for _ in range(steps):
        prior = float(np.clip((n * p).sum() / n.sum(), 0.01, 0.99))
        agree = (n[:, None] * ((v > 0) * p[:, None] + (v < 0) * (1 - p)[:, None])).sum(axis=0)
        cast = (n[:, None] * (v != 0)).sum(axis=0)
        right = np.clip((agree + 8) / (cast + 10), 0.55, 0.99)
        logit = np.log(prior / (1 - prior)) + (v * np.log(right / (1 - right))).sum(axis=1)
        new = 1 / (1 + np.exp(-logit))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return p, right, prior


def classifier(v: np.ndarray, n: np.ndarray, p: np.ndarray, steps: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression on the votes and a constant, with the EM probabilities as targets and the counts as weights."""
    x = np.hstack([v.astype(float), np.ones((len(v), 1))])
    w, n = np.zeros(x.shape[1]), n / n.sum()
    for _ in range(steps):
        q = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x * (n * q * (1 - q))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (n * (q - p)) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def accepted(counts: dict[int, int]) -> set[int]:
    """Vote codes that the classifier takes as personal data. Kinds are learned apart; base forms count as candidates too."""
    out: set[int] = set()
    for kind in range(len(KINDS)):
        codes = [c for c in sorted(counts) if unpack(c)[0] == kind]
        if codes:
            v = np.array([unpack(c)[1] for c in codes])
            n = np.array([counts[c] for c in codes], dtype=float)
            p, _, _ = reliabilities(v, n)
            w = classifier(v, n, p)
            score = np.hstack([v, np.ones((len(v), 1))]) @ w
            # A number that fails its checksum or range only serves as a counterexample.
            out |= {c for c, x, s in zip(codes, v, score, strict=True) if s > 0 and (x[0] > 0 or kind not in (1, 2))}
    return out


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: base counts by kind, the hash of the base spans, and all spans found.

    To the driver come only the counts of vote combinations, at most 4 * 3^4 rows. Null and empty texts have no spans;
    repeated rows are each searched; empty input gives no rows. Other columns are not looked at.
    """
    found = materialise(spans(docs))
    counts = {r["code"]: r["n"] for r in found.select(F.explode("found.code").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = sorted(accepted(counts))
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(own):
        return F.array_join(F.transform(own, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")

    base = F.filter("found", lambda s: s["base"])
    learned = F.array(*[F.lit(c) for c in taken]).cast("array<int>")
    final = F.filter("found", lambda s: s["base"] | F.array_contains(learned, s["code"]))
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(found, s -> s.base and s.kind = {k})) as bigint)").alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(final).alias("spans"),
    )
