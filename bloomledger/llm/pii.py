"""Personal data in whole texts: fixed patterns, and a skip-chain random field that adds to them.

Base spans are the leftmost non-overlapping matches of four patterns with a check each.  The
random field then labels the tokens near digits and @ signs: a token's potentials depend on
the shapes of it and its neighbours, neighbouring tokens share a transition potential, and
distant tokens of a document that carry the same digits or address share a skip potential, so
that evidence at one mention reaches the others.  Two mentions share it directly, more of them
with one hub of their own, so all are two steps apart however many there are.  Marginals come
from loopy message passing over all documents of a batch at once, until messages settle.  Runs of tokens that are labelled with one kind, are
sure enough and plausible become added spans; base spans always stay.

The weights are fitted by pseudo-likelihood on the base labels of at most `SAMPLE_DOCS`
distinct documents that hold a digit or an @, a hub taking the label that most of its mentions
have; all texts are searched.  A token's outline counts whole; long ones by a checksum.

Null text is empty and has no spans.  Rows pass one by one: repeated rows give repeated
results and an empty table an empty one.  Work is linear in a text's length, whatever it
repeats; patterns are written so that long runs are never read twice.  Other columns are not
read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bloomledger.llm.common import settle, table, with_small

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 1200
FEATURES = 1 << 14
SURE = 0.9
ROUNDS = 200  # of message passing, at most
SETTLED = 1e-3  # change of a message (natural log) below which they rest
CONTEXT = 2  # tokens beside one with a digit or @ that the field covers
BATCH_TOKENS = 50_000

_OTHER = len(KINDS)  # the label of everything else
_LABELS = len(KINDS) + 1
_NAMES = 7  # features of a token

_CANDIDATE = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A number that begins a match begins a run of digits.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TRIM = ".,;:!?*&%$#\"'<>[]{}=|~`"

Span = tuple[int, int, int]  # kind, start, end


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """Matches of the four patterns that pass their checks, by kind and start."""
    out: list[Span] = []
    bound, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > bound and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            bound = domain.end()
            out.append((0, start, bound))
        # The characters before this @ can open no later match.
        bound = max(bound, at + 1)
        at = text.find("@", bound)
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0]) if m.end() - m.start() >= 13 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_digits(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in sorted(spans))


# --- the random field -----------------------------------------------------------


def shape(core: str) -> str:
    """A token's outline: runs of letters, of digits by their length, and other characters."""
    out, at = [], 0
    while at < len(core):
        c, end = core[at], at + 1
        if c.isdigit():
            while end < len(core) and core[end].isdigit():
                end += 1
            out.append(f"9{min(end - at, 6)}")
        elif c.isalpha():
            while end < len(core) and core[end].isalpha():
                end += 1
            out.append("a")
        else:
            out.append(c)
        at = end
    whole = "".join(out)
    return whole if len(out) <= 16 else f"{whole[:16]}~{zlib.crc32(whole.encode()):08x}"


def _facts(core: str) -> str:
    """What a check of the kinds would say of a token alone."""
    digits = _digits(core)
    parts = core.split(".")
    quad = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts)
    return "".join(
        (
            "@" if "@" in core[1:-1] else "-",
            "q" if quad and all(map(_small, parts)) else "Q" if quad else "-",
            "l" if 13 <= len(digits) <= 19 and luhn(digits) else "-",
            "+" if core[:1] == "+" else "-",
            str(min(len(digits), 20)),
        )
    )


def mention_key(core: str) -> str | None:
    """What tokens that mention the same thing share: their last digits, or an address."""
    if "@" in core:
        return core.lower()
    digits = _digits(core)
    return digits[-7:] if len(digits) >= 4 else None


class Tokens:
    """Tokens of many documents that the field covers, as a graph."""

    def __init__(self):
        self.features: list[tuple[int, ...]] = []
        self.spans: list[tuple[int, int, int]] = []  # document, start and end of the core
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        self.hubs: list[list[int]] = []  # mentions of each hub
        self._known: dict[str, tuple[str, str]] = {}

    def _look(self, core: str) -> tuple[str, str]:
        known = self._known.get(core)
        if known is None:
            known = self._known[core] = (shape(core), _facts(core) if _CANDIDATE.search(core) else "")
        return known

    def add(self, document: int, text: str) -> None:
        found = []  # core, start, end
        for m in _TOKEN.finditer(text):
            core = m[0].strip(_TRIM) or m[0]
            start = m.start() + m[0].index(core)
            found.append((core, start, start + len(core)))
        marked = [i for i, (core, _, _) in enumerate(found) if _CANDIDATE.search(core)]
        covered = sorted({j for i in marked for j in range(max(i - CONTEXT, 0), min(i + CONTEXT + 1, len(found)))})
        mentions: dict[str, list[int]] = {}
        previous = -2
        for i in covered:
            core, start, end = found[i]
            own, facts = self._look(core)
            before = self._look(found[i - 1][0])[0] if i else "^"
            after = self._look(found[i + 1][0])[0] if i + 1 < len(found) else "$"
            names = ("1", f"s{own}", f"f{facts}", f"p{before}", f"n{after}", f"sp{own}|{before}", f"sn{own}|{after}")
            node = len(self.features)
            self.features.append(tuple(zlib.crc32(n.encode()) % FEATURES for n in names))
            self.spans.append((document, start, end))
            if previous == i - 1:
                self.chain.append((node - 1, node))
            previous = i
            key = mention_key(core) if facts else None
            if key is not None:
                mentions.setdefault(key, []).append(node)
        for nodes in mentions.values():
            if len(nodes) > 2:
                self.hubs.append(nodes)
            elif len(nodes) == 2 and nodes[1] != nodes[0] + 1:  # neighbours are linked already
                self.skip.append((nodes[0], nodes[1]))

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features of the tokens, chain and skip edges; hubs are numbered behind the tokens."""
        skip = self.skip + [(node, len(self.features) + hub) for hub, nodes in enumerate(self.hubs) for node in nodes]
        pairs = [np.array(e, np.int64).reshape(-1, 2) for e in (self.chain, skip)]
        return np.array(self.features, np.int64).reshape(len(self.features), _NAMES), *pairs

    def labels(self, spans: list[list[Span]]) -> np.ndarray:
        """The kind of the base span that each token overlaps."""
        out = np.full(len(self.spans), _OTHER)
        for node, (document, start, end) in enumerate(self.spans):
            for kind, s, e in spans[document]:
                if s < end and start < e:
                    out[node] = kind
                    break
        return out


Weights = tuple[np.ndarray, np.ndarray, np.ndarray]  # features x labels, chain and skip: labels x labels


def no_weights() -> Weights:
    return np.zeros((FEATURES, _LABELS)), np.zeros((_LABELS, _LABELS)), np.zeros((_LABELS, _LABELS))


def fit(texts: list[str], steps: int = 200, decay: float = 1e-4) -> Weights:
    """Weights by pseudo-likelihood: each token's label given its neighbours' in the graph."""
    tokens, spans = Tokens(), []
    for text in texts:
        tokens.add(len(spans), text)
        spans.append(base_spans(text))
    features, chain, skip = tokens.arrays()
    weights = no_weights()
    n = len(features)
    if not n:
        return weights
    label = tokens.labels(spans)
    truth = np.eye(_LABELS)[label]
    hubs = [np.bincount(label[nodes], minlength=_LABELS).argmax() for nodes in tokens.hubs]
    label = np.concatenate([label, np.array(hubs, label.dtype)])
    squares = [np.full_like(w, 1e-8) for w in weights]
    for _ in range(steps):
        score = np.zeros((len(label), _LABELS))
        score[:n] = weights[0][features].sum(axis=1)
        for theta, edges in ((weights[1], chain), (weights[2], skip)):
            np.add.at(score, edges[:, 1], theta[label[edges[:, 0]]])
            np.add.at(score, edges[:, 0], theta.T[label[edges[:, 1]]])
        score = score[:n]  # hubs are given, they are not explained
        score -= score.max(axis=1, keepdims=True)
        chance = np.exp(score)
        chance /= chance.sum(axis=1, keepdims=True)
        miss = np.zeros((len(label), _LABELS))
        miss[:n] = (truth - chance) / n
        slopes = [
            np.stack([np.bincount(features.ravel(), np.repeat(miss[:n, k], features.shape[1]), FEATURES) for k in range(_LABELS)], axis=1)
        ]
        for edges in (chain, skip):
            slope = np.zeros((_LABELS, _LABELS))
            np.add.at(slope, label[edges[:, 0]], miss[edges[:, 1]])
            back = np.zeros((_LABELS, _LABELS))
            np.add.at(back, label[edges[:, 1]], miss[edges[:, 0]])
            slopes.append(slope + back.T)
        for w, g, s in zip(weights, slopes, squares):
            g = g - decay * w
            s += g * g
            w += 0.3 * g / np.sqrt(s)
    skip_weights = (weights[2] + weights[2].T) / 2  # a skip edge has no direction
    return weights[0], weights[1], skip_weights


def marginals(weights: Weights, features: np.ndarray, chain: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """Label probabilities of each token by damped loopy message passing.

    Nodes behind the tokens, which only skip edges name, are hubs without features.
    """
    n = len(features)
    own = np.zeros((max(n, int(skip.max(initial=-1)) + 1), _LABELS))
    own[:n] = weights[0][features].sum(axis=1)
    source = np.concatenate([chain[:, 0], chain[:, 1], skip[:, 0], skip[:, 1]])
    target = np.concatenate([chain[:, 1], chain[:, 0], skip[:, 1], skip[:, 0]])
    c, s = len(chain), len(skip)
    reverse = np.concatenate([np.arange(c, 2 * c), np.arange(c), np.arange(2 * c + s, 2 * c + 2 * s), np.arange(2 * c, 2 * c + s)])
    factors = [(slice(0, c), weights[1]), (slice(c, 2 * c), weights[1].T), (slice(2 * c, None), weights[2])]
    message = np.zeros((len(source), _LABELS))

    def gathered() -> np.ndarray:
        return own + np.stack([np.bincount(target, message[:, k], len(own)) for k in range(_LABELS)], axis=1)

    for _ in range(ROUNDS if len(source) else 0):
        sent = gathered()[source] - message[reverse]
        sent -= sent.max(axis=1, keepdims=True)
        fresh = np.empty_like(message)
        for part, theta in factors:
            fresh[part] = np.log(np.exp(sent[part]) @ np.exp(theta) + 1e-300)
        fresh -= fresh.max(axis=1, keepdims=True)
        change = np.abs(fresh - message).max()
        message = 0.5 * message + 0.5 * fresh
        if change < SETTLED:
            break
    belief = gathered()[:n]
    belief = np.exp(belief - belief.max(axis=1, keepdims=True))
    return belief / belief.sum(axis=1, keepdims=True)


def _plausible(kind: int, text: str) -> bool:
    digits = len(_digits(text))
    if kind == 0:
        return "@" in text[1:-1]
    if kind == 1:
        return text.count(".") >= 3 and digits >= 4
    return 13 <= digits <= 19 if kind == 2 else 7 <= digits <= 15


def added_spans(weights: Weights, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
    """Spans beside the base ones that the field is sure of, for each text."""
    out: list[list[Span]] = [[] for _ in texts]
    tokens = Tokens()
    for document, text in enumerate(texts):
        if _CANDIDATE.search(text):
            tokens.add(document, text)
        if len(tokens.features) >= BATCH_TOKENS or document == len(texts) - 1:
            if tokens.features:
                _decode(weights, tokens, texts, base, out)
            tokens = Tokens()
    return out


def _decode(weights: Weights, tokens: Tokens, texts: list[str], base: list[list[Span]], out: list[list[Span]]) -> None:
    chance = marginals(weights, *tokens.arrays())
    best = chance.argmax(axis=1)
    sure = (best != _OTHER) & (chance.max(axis=1) >= SURE)
    follows = {b: a for a, b in tokens.chain}
    runs: list[list[int]] = []
    for node in np.flatnonzero(sure).tolist():
        if runs and follows.get(node) == runs[-1][-1] and best[runs[-1][-1]] == best[node]:
            runs[-1].append(node)
        else:
            runs.append([node])
    for run in runs:
        document, start = tokens.spans[run[0]][:2]
        end, kind = tokens.spans[run[-1]][2], int(best[run[0]])
        taken = any(s < end and start < e for _, s, e in base[document])
        if not taken and _plausible(kind, texts[document][start:end]):
            out[document].append((kind, start, end))


# --- on documents -----------------------------------------------------------------


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Weights:
    """Weights from a bounded sample of documents, the same on every run.

    The distinct (id, text) with the least hashes are the sample.  Their share follows from a
    count, so only about four times as many are put in order.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.filter(F.col("text").rlike("[0-9@]")).withColumn("hash", F.xxhash64("doc_id", "text"))
    ids = settle(rows.select("hash").distinct())
    place = F.pmod("hash", F.lit(1 << 40))
    near = ids.filter(place < F.lit(4 * sample_docs * (1 << 40) // max(ids.count(), 1)))
    chosen = settle(near.orderBy(place, "hash").limit(sample_docs).withColumnRenamed("hash", "chosen"))
    sample = with_small(rows, chosen, F.col("hash") == F.col("chosen"), "left_semi").dropDuplicates(["hash"])
    return fit(sample.orderBy(place, "hash").select("text").toArrow()["text"].to_pylist())


_SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
)


def find_personal_data(docs: DataFrame, weights: Weights) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) if _CANDIDATE.search(t) else [] for t in texts]
            added = added_spans(shared.value, texts, base)
            counts = np.zeros((len(KINDS), len(texts)), np.int64)
            for row, spans in enumerate(base):
                for kind, _, _ in spans:
                    counts[kind, row] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(c) for c in counts),
                    pa.array([hashlib.sha256(written(s).encode()).hexdigest() for s in base], pa.string()),
                    pa.array([written(s + more) for s, more in zip(base, added)], pa.string()),
                    pa.array([len(more) for more in added], pa.int64()),
                ],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(find, _SCHEMA)


def op1_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find_personal_data(docs, learn(docs))
