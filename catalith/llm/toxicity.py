"""Toxicity scores by weak supervision.

Many voters look at a text; each says "toxic" or abstains. Pattern voters are fixed
(`PATTERNS`, word lists and forms of address in four languages). Lexicon voters are
mined: word starts and whole words, at several counts, that labelled toxic texts hold
far more often than clean ones.

A generative model explains the votes by a hidden label. Its accuracies are how often
each voter fires under either label; its correlations are those pairs of voters that
depend on each other even when the label is given. The strongest form a forest, and a
voter is judged given its parent, so agreeing copies of one voter do not count twice.
Accuracies start from labelled rows and are refined over the votes of all documents that
may be learned from, expectation and maximisation in turn: one Spark aggregate a round,
of which `2 * voters ** 2` numbers reach the driver.

The model's posterior labels train a linear classifier (logistic regression over counts
of the mined terms and the votes), and that scores every text.

Bounded: terms and classifier are fitted on about `SAMPLE` rows of each of three kinds
(labelled toxic, labelled clean, without label), drawn by a hash of the id and weighted
back to their numbers. `TERMS` terms and 62 voters at most. Votes, accuracies and
correlations cover all rows. Every text is scanned once and whole.

Rows with a null label are not learned from, nor are held-out rows; a label other than 0
counts as 1, the largest if an id has several. With no labels of one kind there is
nothing to learn, and every score is 0. Null, empty and wordless texts are scored like
texts in which no voter fires. Repeated rows are scored each; rows with a null id are
scored, but not learned from. An empty table gives no rows. Of other columns none is read.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.checkpoints import stage, staging_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 8192
TERMS, LEXICON = 384, 48
THRESHOLD = 0.3
STARTS = (3, 4, 5, 6, 7)  # characters of a word start that may be a term
COUNTS = (1, 2, 4)  # least numbers of words with that start
LEAST_TOXIC, LEAST_LOG_LIFT, CONFIDENCE = 4, 0.7, 1.645
ROUNDS = 4
LABEL_NOISE = 0.02
RIDGE = 1.0
# A pair is correlated if twice its conditional mutual information, over all rows, is beyond this.
LEAST_DEPENDENCE = 25.0
COUNTED_AT_ONCE, REMEMBERED = 500_000, 500_000
WORD = r"[^\W\d_]+"
# Voters by form.
PATTERNS = {
    "mind": r"\b(?:idiots?|morons?|imbeciles?|stupid|dumb|fools?|brainless|idioten?|dumm(?:kopf)?|blöd|débile|imbécile|tont[oa]s?|estúpid[oa]s?)\b",
    "worth": r"\b(?:losers?|worthless|useless|pathetic|trash|garbage|scum|versager|abschaum|minable|ordure|basura|inútil)\b",
    "disgust": r"\b(?:disgusting|vile|filthy|repulsive|ekelhaft|widerlich|dégueulasse|asqueros[oa])\b",
    "address": r"\byou(?: are|'re)? (?:an? |such an? |all )?(?:\w+ )?(?:idiots?|morons?|losers?|fools?|clowns?|trash|scum)\b",
    "threat": r"\b(?:shut up|go to hell|i hate you|get lost|halt die klappe|ta gueule|te odio)\b",
    "masked": r"\b[a-z]+[*@#$]{2,}[a-z]+\b",
    "shout": r"[!?]{3,}",
    "lengthened": r"([a-z])\1{3,}",
}


@dataclass
class Voters:
    """The mined terms in order of their strength, as (start, least count); the first `LEXICON` of them vote."""

    terms: list[tuple[str, int]]

    @property
    def n_lexicon(self) -> int:
        return min(LEXICON, len(self.terms))

    @property
    def n_votes(self) -> int:
        return self.n_lexicon + len(PATTERNS)


@dataclass
class LabelModel:
    """P(label), and for each voter and label P(fires | parent's vote), with the voter's parent or -1."""

    prior: float
    parent: np.ndarray
    fires: np.ndarray  # [label, parent's vote, voter]

    def posterior(self, votes: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
        """P(toxic | votes) of each row; a known label (0, 1, or -1) is one more, rarely wrong voter."""
        given = np.where(self.parent >= 0, votes[:, np.maximum(self.parent, 0)], 0)
        at = np.arange(votes.shape[1])
        logs = np.zeros((2, len(votes)))
        for y in (0, 1):
            p = self.fires[y][given, at]
            logs[y] = np.log(np.where(votes == 1, p, 1 - p)).sum(axis=1)
        odds = logs[1] - logs[0] + math.log(self.prior / (1 - self.prior))
        if label is not None:
            sure = math.log((1 - LABEL_NOISE) / LABEL_NOISE)
            odds = odds + np.where(label == 1, sure, np.where(label == 0, -sure, 0.0))
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


@dataclass
class Model:
    voters: Voters
    labels: LabelModel
    weights: np.ndarray
    bias: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights + self.bias, -40, 40)))


def is_held_out(doc: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(f"`{doc}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _starts(word: str) -> Iterator[str]:
    """The terms a word belongs to, but for their counts: its starts, and the whole word."""
    for k in STARTS:
        if len(word) >= k:
            yield word[:k]
    yield word + "$"


def _term_counts(words: list[str]) -> Iterator[tuple[str, int]]:
    found = Counter()
    for word, n in Counter(words).items():
        for start in _starts(word):
            found[start] += n
    for start, n in found.items():
        for least in COUNTS:
            if n >= least:
                yield start, least


def _learned(labels: DataFrame, doc: str, label: str) -> DataFrame:
    """(_doc, _y): one label for each id that may be learned from."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc).isNotNull() & ~is_held_out(doc))
    return known.groupBy(F.col(doc).alias("_doc")).agg(F.max((F.col(label) != 0).cast("int")).alias("_y"))


def _draw(doc: str) -> Column:
    return F.pmod(F.xxhash64(F.col(doc), F.lit("toxicity sample")), F.lit(1 << 30))


def _limit(n: int) -> int:
    return min(1 << 30, (SAMPLE << 30) // max(n, 1))


def mined_terms(texts: DataFrame) -> list[tuple[str, int]]:
    """Terms of the rows (_y, text), by how surely they are more frequent in toxic texts, nested repeats left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = re.compile(WORD).findall
        found: dict[tuple[str, int], list[int]] = {}

        def rows() -> pa.RecordBatch:
            keys = list(found)
            columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32())]
            columns += [pa.array([found[k][y] for k in keys], pa.int64()) for y in (0, 1)]
            found.clear()
            return pa.record_batch(columns, ["term", "least", "clean", "toxic"])

        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for key in _term_counts(split((t.as_py() or "").lower())):
                    found.setdefault(key, [0, 0])[y] += 1
                if len(found) > COUNTED_AT_ONCE:
                    yield rows()
        yield rows()

    sums = F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    n = texts.groupBy().agg(F.sum("_y").alias("toxic"), F.sum(1 - F.col("_y")).alias("clean")).first()
    counts = texts.select("_y", "text").mapInArrow(run, "term string, least int, clean bigint, toxic bigint").groupBy("term", "least").agg(*sums)
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    lift = F.log(a / (n["toxic"] + 1)) - F.log(b / (n["clean"] + 1)) - CONFIDENCE * F.sqrt(1 / a + 1 / b)
    strong = counts.where(F.col("toxic") >= LEAST_TOXIC).withColumn("lift", lift).where(F.col("lift") >= LEAST_LOG_LIFT)
    # A strong term that many texts hold goes before a stronger one that few do.
    order = [F.desc(F.col("lift") * F.col("toxic")), F.length("term"), "term", "least"]
    rows = strong.orderBy(*order).limit(4 * TERMS).collect()
    chosen, held = [], set()
    for r in rows:
        # A start and its longer forms that stand in the same numbers of texts are one term.
        key = (r["term"][: STARTS[0]], r["least"], r["toxic"], r["clean"])
        if key not in held and len(chosen) < TERMS:
            held.add(key)
            chosen.append((r["term"], r["least"]))
    return chosen


def scanned(docs: DataFrame, voters: Voters, doc: str, text: str) -> DataFrame:
    """(doc, votes, terms, counts): votes as bits, and of each term that the text holds its number and count."""
    kind = docs.schema[doc].dataType.simpleString()
    starts = {s: i for i, s in enumerate(dict.fromkeys(s for s, _ in voters.terms))}
    votes_of = [(k, starts[s], least) for k, (s, least) in enumerate(voters.terms[: voters.n_lexicon])]
    n_lexicon = voters.n_lexicon

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = re.compile(WORD).findall
        patterns = [re.compile(p).search for p in PATTERNS.values()]
        known: dict[str, tuple[int, ...]] = {}

        def look(t: str) -> tuple[int, Counter]:
            found: Counter = Counter()
            for word, n in Counter(split(t)).items():
                hit = known.get(word)
                if hit is None:
                    hit = known[word] = tuple(starts[s] for s in _starts(word) if s in starts)
                for s in hit:
                    found[s] += n
            if len(known) > REMEMBERED:
                known.clear()
            bits = sum(1 << (n_lexicon + k) for k, search in enumerate(patterns) if search(t))
            if found:
                bits |= sum(1 << k for k, s, least in votes_of if found[s] >= least)
            return bits, +found

        for batch in batches:
            rows = [look((t.as_py() or "").lower()) for t in batch.column(1)]
            yield pa.record_batch(
                [batch.column(0), pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([list(r[1]) for r in rows], pa.list_(pa.int32())),
                 pa.array([list(r[1].values()) for r in rows], pa.list_(pa.int32()))],
                ["_doc", "votes", "terms", "counts"],
            )

    rows = docs.select(F.col(doc).alias("_doc"), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"_doc {kind}, votes bigint, terms array<int>, counts array<int>")


def unpacked(votes: np.ndarray, n: int) -> np.ndarray:
    return (votes[:, None] >> np.arange(n)) & 1


def vote_sums(patterns: DataFrame, n: int, model: LabelModel | None) -> np.ndarray:
    """[label, voter, voter]: expected rows of each label in which both voters fire; last row and column count all rows.

    `patterns` are rows (votes, y, n); without a model only labelled ones count.
    """
    # A few numbers for each voter, and plain ones: tasks need not have this package.
    numbers = None if model is None else (model.prior, model.parent, model.fires)
    shared = patterns.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if shared.value is None else LabelModel(*shared.value)
        total = np.zeros((2, n + 1, n + 1))
        for batch in batches:
            votes = unpacked(batch.column(0).to_numpy(), n)
            y = batch.column(1).fill_null(-1).to_numpy()
            rows = batch.column(2).to_numpy()
            toxic = (y == 1).astype(float) if own is None else own.posterior(votes, y)
            clean = (y == 0).astype(float) if own is None else 1 - toxic
            with_all = np.column_stack([votes, np.ones(len(votes), votes.dtype)]).astype(float)
            for k, share in enumerate((clean, toxic)):
                total[k] += (with_all * (share * rows)[:, None]).T @ with_all
        cells = np.flatnonzero(total)
        yield pa.record_batch([pa.array(cells.astype(np.int32)), pa.array(total.ravel()[cells])], ["cell", "rows"])

    out = np.zeros((2, n + 1, n + 1))
    sums = patterns.select("votes", "y", "n").mapInArrow(run, "cell int, rows double").groupBy("cell").agg(F.sum("rows").alias("rows"))
    for r in sums.collect():
        out.ravel()[r["cell"]] = r["rows"]
    return out


def _dependence(sums: np.ndarray) -> np.ndarray:
    """Twice the conditional mutual information of each pair of voters given the label, over all rows."""
    n = sums.shape[1] - 1
    out = np.zeros((n, n))
    for s in sums:
        all_rows = s[n, n] + 1.0
        one = (s[n, :n] + 0.5) / all_rows
        both = (s[:n, :n] + 0.25) / all_rows
        for i_fires, j_fires in ((1, 1), (1, 0), (0, 1), (0, 0)):
            pi, pj = (one if i_fires else 1 - one)[:, None], (one if j_fires else 1 - one)[None, :]
            joint = {(1, 1): both, (1, 0): one[:, None] - both, (0, 1): one[None, :] - both, (0, 0): 1 - one[:, None] - one[None, :] + both}
            p = np.maximum(joint[i_fires, j_fires], 1e-12)
            out += 2 * all_rows * p * np.log(p / np.maximum(pi * pj, 1e-12))
    np.fill_diagonal(out, 0)
    return out


def correlated_forest(sums: np.ndarray) -> np.ndarray:
    """The parent of each voter: a maximum spanning forest of the pairs that are surely correlated."""
    link = _dependence(sums)
    n = len(link)
    parent, placed = np.full(n, -1), np.zeros(n, bool)
    while not placed.all():
        inside = np.flatnonzero(placed)
        outside = np.flatnonzero(~placed)
        best = link[np.ix_(inside, outside)] if len(inside) else np.zeros((0, 0))
        if best.size and best.max() > LEAST_DEPENDENCE:
            i, j = np.unravel_index(best.argmax(), best.shape)
            parent[outside[j]] = inside[i]
            placed[outside[j]] = True
        else:
            placed[outside[np.argmax(link[outside].sum(axis=1))]] = True
    return parent


def label_model(sums: np.ndarray, prior: float, parent: np.ndarray | None = None) -> LabelModel:
    """The model of greatest likelihood for expected counts, a little smoothed."""
    n = sums.shape[1] - 1
    parent = correlated_forest(sums) if parent is None else parent
    fires = np.zeros((2, 2, n))
    at = np.arange(n)
    p = np.maximum(parent, 0)
    for y in (0, 1):
        s = sums[y]
        alone = (s[n, :n] + 0.5) / (s[n, n] + 1.0)
        with_parent = (s[at, p] + 2 * alone) / (s[n, p] + 2)
        without = (s[n, :n] - s[at, p] + 2 * alone) / (s[n, n] - s[n, p] + 2)
        fires[y, 0] = np.where(parent >= 0, without, alone)
        fires[y, 1] = np.where(parent >= 0, with_parent, alone)
    return LabelModel(prior, parent, np.clip(fires, 1e-6, 1 - 1e-6))


def feature_rows(batch_votes: np.ndarray, terms: pa.Array, counts: pa.Array, voters: Voters) -> np.ndarray:
    """Counts of the terms' starts, on a log scale, and the votes."""
    n_starts = len(dict.fromkeys(s for s, _ in voters.terms))
    n = len(batch_votes)
    out = np.zeros((n, n_starts + voters.n_votes), np.float32)
    sizes = np.diff(terms.offsets.to_numpy())
    if sizes.sum():
        flat = slice(int(terms.offsets[0].as_py()), int(terms.offsets[-1].as_py()))
        at = terms.values.to_numpy()[flat]
        out[np.repeat(np.arange(n), sizes), at] = np.log1p(counts.values.to_numpy()[flat])
    out[:, n_starts:] = unpacked(batch_votes, voters.n_votes)
    return out


def logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, float]:
    """Weighted logistic regression towards soft labels, by Newton steps; weights of rows sum to their number."""
    weight = weight * (len(weight) / weight.sum())
    x1 = np.column_stack([x, np.ones(len(x), np.float32)])
    penalty = np.full(x1.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x1.shape[1])
    share = np.clip(np.average(target, weights=weight), 1e-6, 1 - 1e-6)
    w[-1] = math.log(share / (1 - share))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -40, 40)))
        gradient = x1.T @ (weight * (p - target)) + penalty * w
        curve = (x1 * (weight * np.maximum(p * (1 - p), 1e-4))[:, None].astype(np.float32)).T @ x1
        step = np.linalg.solve(curve.astype(float) + np.diag(penalty), gradient)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1].astype(np.float32), float(w[-1])


def train(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic") -> tuple[Model | None, DataFrame]:
    """The model, and the scanned documents as a table, so that scoring need not read the texts again."""
    spark = docs.sparkSession
    folder = staging_folder(spark)
    known = stage(_learned(labels, doc, label), folder, "labels")
    n = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return None, scanned(docs, Voters([]), doc, text)
    # About 2 * SAMPLE ids, whatever the size of the tables.
    limit = F.when(F.col("_y") == 1, _limit(n[1])).otherwise(_limit(n[0]))
    sample = F.broadcast(known.where(_draw("_doc") < limit))
    texts = docs.select(F.col(doc).alias("_doc"), F.col(text).alias("text")).join(sample, "_doc").select("_y", "text")
    texts = stage(texts, folder, "sample")
    if texts.where("_y = 1").isEmpty() or texts.where("_y = 0").isEmpty():
        return None, scanned(docs, Voters([]), doc, text)
    voters = Voters(mined_terms(texts))

    rows = stage(scanned(docs, voters, doc, text), folder, "votes")
    usable = rows.where(F.col("_doc").isNotNull() & ~is_held_out("_doc")).join(known.withColumnRenamed("_y", "y"), "_doc", "left")
    usable = stage(usable, folder, "usable")
    patterns = stage(usable.groupBy("votes", "y").agg(F.count(F.lit(1)).alias("n")), folder, "patterns")
    sums = vote_sums(patterns, voters.n_votes, None)
    prior = sums[1, -1, -1] / (sums[0, -1, -1] + sums[1, -1, -1])
    model = label_model(sums, prior)
    for _ in range(ROUNDS):
        # Who depends on whom is found anew, from all rows.
        model = label_model(vote_sums(patterns, voters.n_votes, model), prior)

    kinds = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # three kinds
    limits = F.when(F.col("y") == 1, _limit(kinds.get(1, 0))).when(F.col("y") == 0, _limit(kinds.get(0, 0))).otherwise(_limit(kinds.get(None, 0)))
    drawn = usable.where(_draw("_doc") < limits).orderBy("_doc", "votes").select("votes", "y", "terms", "counts").toArrow()
    y = drawn["y"].combine_chunks().fill_null(-1).to_numpy()
    votes = drawn["votes"].combine_chunks().to_numpy()
    x = feature_rows(votes, *(_one(drawn[c]) for c in ("terms", "counts")), voters)
    target = model.posterior(unpacked(votes, voters.n_votes), y)
    number = {-1 if k is None else k: v for k, v in kinds.items()}
    weight = np.array([number[k] / max(1, int((y == k).sum())) for k in y.tolist()])
    return Model(voters, model, *logistic(x, target, weight)), rows


def _one(column: pa.ChunkedArray) -> pa.Array:
    joined = column.combine_chunks()
    return joined.chunk(0) if isinstance(joined, pa.ChunkedArray) else joined


def predict(model: Model | None, rows: DataFrame, doc: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, held_out, score, predicted, from the scanned rows of `train`."""
    kind = rows.schema["_doc"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(
        None if model is None else (model.weights, model.bias, model.voters.terms)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        voters = Voters(own[2]) if own else None
        for batch in batches:
            score = np.zeros(batch.num_rows)
            if own:
                x = feature_rows(batch.column(1).to_numpy(), batch.column(2), batch.column(3), voters)
                score = 1 / (1 + np.exp(-np.clip(x @ own[0] + own[1], -40, 40)))
            columns = [pa.array(score.astype(float)), pa.array((score >= threshold).astype(np.int32))]
            yield pa.record_batch([batch.column(0), *columns], ["_doc", "score", "predicted"])

    found = rows.select("_doc", "votes", "terms", "counts").mapInArrow(run, f"_doc {kind}, score double, predicted int")
    return found.select(F.col("_doc").alias(doc), is_held_out("_doc").alias("held_out"), "score", "predicted")


def score(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """One row per document: id, held_out, score from 0 to 1, predicted."""
    model, rows = train(docs, labels, doc, text, label)
    return predict(model, rows, doc)
