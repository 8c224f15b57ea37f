"""Personal data by weak supervision.

Every span that looks at all like personal data is a candidate.  Labelers - strict
regex forms, gazetteers and context words - vote for, against or not at all.
Expectation-maximisation over the counts of all vote patterns estimates how reliable
each labeler is; its posteriors train a final classifier on vote and shape features,
which decides on the candidates beyond the strict forms.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.llm.common import forget, slices, staged

KINDS = ("email", "ip", "card", "phone", "secret")
EMAIL, IP, CARD, PHONE, SECRET = range(5)

# Gazetteers and cue words, fixed values.
MAIL_ENDINGS = frozenset("com org net edu gov info biz io de fr es uk eu it nl at ch us ca".split())
CUES = {
    EMAIL: frozenset("mail email e-mail mailto contact write from to correo courriel kontakt".split()),
    IP: frozenset("ip address host server ping adresse client login".split()),
    CARD: frozenset("card visa mastercard amex credit debit payment karte carte tarjeta".split()),
    PHONE: frozenset("phone call tel telephone mobile fax whatsapp sms anruf llame".split()),
    SECRET: frozenset("token key secret password passwd pwd api apikey api_key auth bearer".split()),
}
AGAINST = frozenset("version v isbn order invoice total sum page article sku serial commit sha sha1 md5 hash checksum".split())
NO_NETWORK = ("0.", "127.", "255.")
CARD_PREFIXES = ("34", "35", "36", "37", "38", "4", "51", "52", "53", "54", "55", "6011", "62", "65")

_domain = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_ip = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_card = re.compile(r"[0-9](?:[ -]?[0-9])++")
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_secret = re.compile(r"(?<![0-9A-Za-z])[0-9A-Za-z_\-]{32,}(?![0-9A-Za-z])")
_hidden_mail = re.compile(r"(?<![\w.])[A-Za-z0-9._+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,64}(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]{1,64})+")
_plain_phone = re.compile(r"(?<![\w.+-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![\w-])")
_cue = re.compile(r"[\w-]+")


def luhn(digits: str) -> bool:
    """The check digit holds."""
    odd = sum(map(int, digits[-1::-2]))
    even = sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def strict_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of strict forms, leftmost without overlap in each kind, by start and kind."""
    found = []
    if "@" in text:
        last = 0
        for m in _domain.finditer(text):
            start = at = m.start()
            while start > last and text[start - 1] in _local:
                start -= 1
            if start < at:
                last = m.end()
                found.append((start, EMAIL, last))
    for m in _ip.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((m.start(), IP, m.end()))
    for m in _card.finditer(text):
        if 14 <= m.end() - m.start() <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), CARD, m.end()))
    if "+" in text:
        for m in _phone.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append((m.start(), PHONE, m.end()))
    found.sort()
    return found


def loose_spans(text: str, strict: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of candidates that overlap no strict span or one another."""
    found = [(m.start(), CARD, m.end()) for m in _card.finditer(text) if 13 <= sum(c.isdigit() for c in m.group()) <= 19]
    found += [(m.start(), PHONE, m.end()) for m in _plain_phone.finditer(text)]
    found += [(m.start(), SECRET, m.end()) for m in _secret.finditer(text) if any(c.isdigit() for c in m.group()) and not m.group().isdigit()]
    if "at" in text and ("[" in text or "(" in text):
        found += [(m.start(), EMAIL, m.end()) for m in _hidden_mail.finditer(text)]
    taken, out = sorted((s, e) for s, _, e in strict), []
    at, free = 0, 0
    for start, kind, end in sorted(found):
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if start >= free and (at == len(taken) or taken[at][0] >= end):
            out.append((start, kind, end))
            free = end
    return out


def votes(text: str, start: int, kind: int, end: int, strict: bool) -> tuple[int, ...]:
    """1 for, -1 against, 0 none, by labeler: strict form, checksum or range, gazetteer, cue word, counter cue, surroundings, mixed alphabet."""
    span = text[start:end]
    words = [w.lower() for w in _cue.findall(text[max(0, start - 40) : start])][-4:]
    digits = "".join(c for c in span if c.isdigit() and c.isascii())
    form = 1 if strict else -1 if kind in (CARD, PHONE) else 0
    check = gazetteer = alphabet = 0
    if kind == CARD:
        check = 1 if luhn(digits) else -1
        gazetteer = 1 if digits.startswith(CARD_PREFIXES) else -1
    elif kind == IP:
        check = -1 if len(set(span.split("."))) == 1 else 1
        gazetteer = -1 if span.startswith(NO_NETWORK) else 0
    elif kind == PHONE:
        check = 1 if 10 <= len(digits) <= 15 else -1
        gazetteer = -1 if len(set(digits)) <= 2 else 0
    elif kind == EMAIL:
        check = 1 if span.count("@") == 1 else 0
        gazetteer = 1 if re.split(r"[.\s\])]+", span.lower())[-1] in MAIL_ENDINGS else -1
    else:
        alphabet = 1 if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", span) else 0
        check = 1 if len(set(span)) >= 10 else -1
    cue = 1 if CUES[kind].intersection(words) else -1 if kind == SECRET else 0
    counter = -1 if AGAINST.intersection(words) else 0
    beside = text[start - 1 : start] + text[end : end + 1]
    around = -1 if any(c.isalnum() or c in "_=/\\" for c in beside) else 0
    return form, check, gazetteer, cue, counter, around, alphabet


LABELERS = 7


def code(kind: int, vote: tuple[int, ...], length: int) -> int:
    """Kind, votes and a length class as one number."""
    out = kind * 4 + min(3, length.bit_length() // 2)
    for v in vote:
        out = out * 3 + v + 1
    return out


def decoded(number: int) -> tuple[int, int, list[int]]:
    vote = []
    for _ in range(LABELERS):
        number, v = divmod(number, 3)
        vote.append(v - 1)
    return number // 4, number % 4, vote[::-1]


def estimate(patterns: list[tuple[int, int]], rounds: int = 50) -> dict[int, float]:
    """Posterior that a candidate is personal data for each (code, count).

    For every kind, the share of true spans and, for every labeler, the chances of each
    vote given the truth.  The start believes votes; smoothing keeps unseen votes possible.
    """
    out: dict[int, float] = {}
    for kind in range(len(KINDS)):
        own = [(c, n, decoded(c)[2]) for c, n in patterns if decoded(c)[0] == kind]
        if not own:
            continue
        vote = np.array([v for *_, v in own]) + 1
        count = np.array([n for _, n, _ in own], float)
        true = 1 / (1 + np.exp(-(vote - 1).sum(1).astype(float)))
        for _ in range(rounds):
            prior = (count @ true + 1) / (count.sum() + 2)
            score = np.full(len(own), np.log(prior / (1 - prior)))
            for j in range(LABELERS):
                for v in range(3):
                    hit = vote[:, j] == v
                    # A labeler is taken to be better than chance: a vote never counts against itself.
                    for_ = (count[hit] @ true[hit] + (2 if v == 2 else 1)) / (count @ true + 4)
                    no = (count[hit] @ (1 - true[hit]) + (2 if v == 0 else 1)) / (count @ (1 - true) + 4)
                    weight = np.log(for_ / no)
                    score[hit] += max(weight, 0) if v == 2 else min(weight, 0) if v == 0 else 0
            true = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        out |= {c: float(p) for (c, *_), p in zip(own, true)}
    return out


def train(patterns: list[tuple[int, int]], posterior: dict[int, float], rounds: int = 300) -> dict[int, float]:
    """Probability of each code by a logistic classifier fitted to the posteriors, weighted by count."""
    if not patterns:
        return {}

    def features(number: int) -> np.ndarray:
        kind, length, vote = decoded(number)
        x = np.zeros(len(KINDS) * (1 + 4 + 2 * LABELERS))
        base = kind * (1 + 4 + 2 * LABELERS)
        x[base] = x[base + 1 + length] = 1
        for j, v in enumerate(vote):
            if v:
                x[base + 5 + 2 * j + (v > 0)] = 1
        return x

    x = np.array([features(c) for c, _ in patterns])
    weight = np.sqrt(np.array([n for _, n in patterns], float))
    y = np.array([posterior[c] for c, _ in patterns])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(curve, x.T @ (weight * (y - p)) - 0.1 * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return {c: float(v) for (c, _), v in zip(patterns, p)}


def label(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, spans array<struct<start, kind, end, strict, code>>), one row per input row."""
    kind = docs.schema[id_column].dataType.simpleString()
    span = "struct<start:int, kind:int, end:int, strict:boolean, code:int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, "text"):
            offsets, starts, kinds, ends, strict, codes = [0], [], [], [], [], []
            for text in batch.column(1).to_pylist():
                if text:
                    sure = strict_spans(text)
                    maybe = loose_spans(text, sure)
                    for start, k, end, is_strict in sorted([(*s, True) for s in sure] + [(*s, False) for s in maybe]):
                        starts.append(start)
                        kinds.append(k)
                        ends.append(end)
                        strict.append(is_strict)
                        codes.append(code(k, votes(text, start, k, end, is_strict), end - start))
                offsets.append(len(starts))
            fields = pa.StructArray.from_arrays(
                [pa.array(starts, pa.int32()), pa.array(kinds, pa.int32()), pa.array(ends, pa.int32()), pa.array(strict, pa.bool_()), pa.array(codes, pa.int32())],
                ["start", "kind", "end", "strict", "code"],
            )
            spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), fields)
            yield pa.RecordBatch.from_arrays([batch.column(0), spans], ["id", "spans"])

    narrow = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    return narrow.mapInArrow(run, f"id {kind}, spans array<{span}>").withColumnRenamed("id", id_column)


def probabilities(marked: DataFrame) -> dict[int, float]:
    """Probability of every vote pattern among the spans; only pattern counts reach the driver."""
    counts = marked.select(F.explode("spans.code").alias("code")).groupBy("code").count().collect()
    patterns = sorted((r["code"], r["count"]) for r in counts)
    return train(patterns, estimate(patterns))


def accepted_codes(marked: DataFrame, least: float) -> set[int]:
    return {c for c, p in probabilities(marked).items() if p >= least}


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = 0.9) -> DataFrame:
    """(id, spans array<struct<start, kind, end, strict, probability>>), one row per input row.

    Strict forms always stay; other candidates stay where the classifier gives at least
    ``least``.  A null or empty text has no spans.  Spans are code points, end exclusive,
    by start and kind.  Candidates of all documents are staged, and only counts of vote
    patterns (at most kinds x 4 x 3^labelers) reach the driver, and their probabilities the tasks.
    """
    marked = staged(label(docs, id_column, text_column), "spans")
    probability = probabilities(marked)
    shared = docs.sparkSession.sparkContext.broadcast((np.array(sorted(probability), np.int64), np.array([probability[c] for c in sorted(probability)])))
    span = "struct<start:int, kind:int, end:int, strict:boolean, probability:double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, chance = shared.value
        for batch in batches:
            column = batch.column(1)
            spans, size = column.flatten(), column.value_lengths().to_numpy(zero_copy_only=False)
            codes, strict = spans.field("code").to_numpy(), spans.field("strict").to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
            p = np.where(known[at] == codes, chance[at], 0.0) if len(known) else np.zeros(len(codes))
            keep = strict | (p >= least)
            kept = np.bincount(np.repeat(np.arange(len(size)), size), keep, len(size)).astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum(kept)]).astype(np.int32)
            chosen = pa.array(keep)
            fields = [spans.field(k).filter(chosen) for k in ("start", "kind", "end", "strict")] + [pa.array(p[keep])]
            rows = pa.StructArray.from_arrays(fields, ["start", "kind", "end", "strict", "probability"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), rows)], ["id", "spans"])

    kind = docs.schema[id_column].dataType.simpleString()
    narrow = marked.select(F.col(id_column).alias("id"), "spans")
    return narrow.mapInArrow(run, f"id {kind}, spans array<{span}>").withColumnRenamed("id", id_column)


def replaced(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each (start, kind, end) as its kind in angle brackets; of overlapping spans the first."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
            at = end
    return "".join([*out, text[at:]])


def rewritten(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = 0.9) -> DataFrame:
    """``docs`` with personal data masked: all rows and columns stay, nothing is shuffled.

    The classifier is trained on the candidates of all documents; then each text is
    labelled once more and rewritten where it stands.
    """
    accepted = docs.sparkSession.sparkContext.broadcast(accepted_codes(label(docs, id_column, text_column), least))

    @F.pandas_udf("string")
    def clean(texts):
        def one(text):
            if not text:
                return text
            sure = strict_spans(text)
            maybe = [s for s in loose_spans(text, sure) if code(s[1], votes(text, *s, False), s[2] - s[0]) in accepted.value]
            return replaced(text, sorted(sure + maybe)) if sure or maybe else text

        return texts.map(one, na_action="ignore")

    return docs.withColumn(text_column, clean(docs[text_column])).select(*docs.columns)
