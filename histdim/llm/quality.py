"""Quality rules and an isolation forest on their statistics.

Per document the rule statistics are computed from the whole text with numpy.
An isolation forest is fitted on all labelled rows; the
average path length of a document over its random splits gives an anomaly score,
whose threshold is calibrated on the same labelled rows.  A document is kept if it
passes the base rules and its score isn't above the threshold.

Only statistics are shuffled, and only counts on fixed grids are collected; the forest (some hundred
thousand numbers, whatever the size of the input) travels with the scoring
function, which judges every document where it is read.

Cases: a null or empty text has no words and fails the base rules; a null id is
scored but can have no label; repeated rows are scored each; without labels, or
without good ones, no score is too high, so that the base rules decide alone;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histdim.llm.frames import id_text
from histdim.llm.words import WHITE_SPACE, Words, blocks, same_windows, utf8
from histdim.session import frozen

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEAT_PERCENT = 50
REPEAT_WINDOW = 3

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
              "n_lines", "n_upper", "n_letters", "n_digits", "n_marks")
FEATURES = ("word_length", "symbols", "dup_lines", "repeat_words", "upper", "marks")
# Features and scores lie on grids, so that rows can be counted by them in bounded space.
STEPS, SCORE_STEPS = 1024, 1 << 16


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_SYMBOL = _table(SYMBOLS)
_UPPER = _table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _table(b"abcdefghijklmnopqrstuvwxyz")
_DIGIT = _table(b"0123456789")
_MARK = _table(b"!?\"'()[]{}/\\=+~^_@`;:-")


def statistics(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The statistics of each of the texts."""
    n = len(offs) - 1
    out = {k: np.zeros(n, np.int64) for k in STATISTICS}
    for lo, hi in blocks(offs):
        part, po = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        for k, v in _block_statistics(part, po).items():
            out[k][lo:hi] = v
    return out


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[at[1:]] - sums[at[:-1]]


def _block_statistics(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    words = Words(data, offs)
    first, number = same_windows(words, REPEAT_WINDOW)
    order = np.argsort(number, kind="stable")      # within a number, texts stay in order
    row = words.row[first[order]]
    same = (number[order][1:] == number[order][:-1]) & (row[1:] == row[:-1])
    again = first[order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]] if len(order) else first
    covered = np.zeros(len(words), bool)
    for j in range(REPEAT_WINDOW):
        covered[again + j] = True
    lead = ((data & 0xC0) != 0x80) & ~WHITE_SPACE[data]
    lines, repeated = np.zeros(len(offs) - 1, np.int64), np.zeros(len(offs) - 1, np.int64)
    raw = data.tobytes()
    for i in np.flatnonzero(np.diff(words.bounds)).tolist():
        own = [x for x in raw[offs[i]:offs[i + 1]].split(b"\n") if x.strip()]
        lines[i], repeated[i] = len(own), len(own) - len(set(own))
    return {"n_words": np.diff(words.bounds), "word_chars": _per_text(lead, offs),
            "n_symbols": _per_text(_SYMBOL[data], offs), "n_dup_lines": repeated,
            "n_repeat_words": _per_text(covered, words.bounds), "n_lines": lines,
            "n_upper": _per_text(_UPPER[data], offs), "n_letters": _per_text(_LETTER[data], offs),
            "n_digits": _per_text(_DIGIT[data], offs), "n_marks": _per_text(_MARK[data], offs)}


def base_failed(n_words, n_repeat_words):
    """The base rules, on columns."""
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEAT_PERCENT * n_words)


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """What the forest splits on: shares, which a text's length doesn't move, on
    a scale that tells none from few, in steps of 1 / ``STEPS``."""
    s = {k: np.asarray(v, float) for k, v in stats.items()}
    words, letters = np.maximum(s["n_words"], 1), np.maximum(s["n_letters"], 1)
    shares = np.stack([s["word_chars"] / words, s["n_symbols"] / words, s["n_dup_lines"] / np.maximum(s["n_lines"], 1),
                       s["n_repeat_words"] / words, s["n_upper"] / letters, s["n_marks"] / words], 1)
    return np.rint(np.log1p(20 * shares) * STEPS) / STEPS


@dataclass(frozen=True)
class ForestParams:
    """``rows_per_tree``: a node that holds no more than one in so many good rows is not split;
    ``most_lost``: the largest share of good rows above the threshold;
    ``least_auc``: how far from one half the chance must be that a statistic is higher in a
    bad row than in a good one for the forest to split on it; it also does if more bad rows lie
    beyond the good rows' extremes than chance ``by_chance`` explains."""

    trees: int = 200
    rows_per_tree: int = 256
    depth: int = 16
    most_lost: float = 0.005
    least_auc: float = 0.05
    by_chance: float = 1e-4
    seed: int = 42


LEVELS = 4      # by which all trees grow between two counts of the good rows


class IsolationForest:
    """Random trees over good rows.  A cut is drawn from the node's box, which at
    the root spans all labelled rows: so a share that no good row has is cut off
    early, and a document there ends after a short path.

    Cuts need no rows; where a tree ends and what a leaf stands for follow from how many of all good rows
    each node holds.  These are counted ``LEVELS`` levels at a time by ``count``, which gives
    the rows that end in each node of the forest so far: here in memory, by ``fitted_judge`` as Spark jobs.

    All trees share four arrays by node: feature (-1: a leaf), cut, left child (the
    right one follows it), path length that the leaf stands for.  The first nodes are the roots.
    """

    def __init__(self, good: np.ndarray, labelled: np.ndarray, params: ForestParams):
        self._grow(labelled.min(0), labelled.max(0), len(good), lambda forest: forest.ends(good), params)

    @classmethod
    def counted(cls, low: np.ndarray, high: np.ndarray, n: int, count, params: ForestParams) -> IsolationForest:
        """Grown in the box from ``low`` to ``high`` over ``n`` good rows that ``count`` counts."""
        forest = cls.__new__(cls)
        forest._grow(low, high, n, count, params)
        return forest

    def _grow(self, low: np.ndarray, high: np.ndarray, n: int, count, params: ForestParams) -> None:
        rnd, k = np.random.default_rng(params.seed), params.trees
        self.size, self.depth, self.trees = min(params.rows_per_tree, n), params.depth, k
        self.feature, self.cut, self.left = np.full(k, -1), np.zeros(k), np.zeros(k, np.int64)
        self.length, level = np.zeros(k), np.zeros(k, np.int64)
        rows, parent = np.full(k, n, np.int64), np.full(k, -1)
        active, low, high = np.arange(k), np.tile(low, (k, 1)), np.tile(high, (k, 1))
        while len(active):
            fresh = len(self.feature)
            for _ in range(LEVELS):
                may = (level[active] < params.depth) & (high > low).any(1)
                active, low, high = active[may], low[may], high[may]
                if not len(active):
                    break
                every = np.arange(len(active))
                f = np.argmax(rnd.random(low.shape) * (high > low), 1)
                at = rnd.uniform(low[every, f], high[every, f])
                left = len(self.feature) + 2 * every
                self.feature[active], self.cut[active], self.left[active] = f, at, left
                self.feature, self.cut = np.append(self.feature, np.full(2 * len(active), -1)), np.append(self.cut, np.zeros(2 * len(active)))
                self.left, parent = np.append(self.left, np.zeros(2 * len(active), np.int64)), np.append(parent, np.repeat(active, 2))
                level = np.append(level, np.repeat(level[active] + 1, 2))
                low, high = np.repeat(low, 2, 0), np.repeat(high, 2, 0)
                high[2 * every, f], low[2 * every + 1, f] = at, at
                active = (left[:, None] + [0, 1]).ravel()
            if len(self.feature) == fresh:
                break
            rows = np.append(rows, np.zeros(len(self.feature) - fresh, np.int64))
            rows[fresh:] = count(self)[fresh:]
            for x in range(int(level.max()), 0, -1):      # inner nodes hold what their children hold
                nodes = fresh + np.flatnonzero((level[fresh:] == x) & (parent[fresh:] >= fresh))
                np.add.at(rows, parent[nodes], rows[nodes])
            self.feature[rows * self.size <= n] = -1
            below = self._reached()[active] & (rows[active] * self.size > n)
            active, low, high = active[below], low[below], high[below]
        self._pack(level + average_path(self.size * rows / max(n, 1)))

    def _reached(self) -> np.ndarray:
        """The nodes that a row can come to."""
        found, now = np.zeros(len(self.feature), bool), np.arange(self.trees)
        while len(now):
            found[now] = True
            now = now[self.feature[now] >= 0]
            now = (self.left[now][:, None] + [0, 1]).ravel()
        return found

    def _pack(self, length: np.ndarray) -> None:
        kept = self._reached()
        place = np.cumsum(kept) - 1
        self.feature, self.cut, self.length = self.feature[kept], self.cut[kept], length[kept]
        self.left = np.where(self.feature >= 0, place[self.left[kept]], 0)

    def _leaf(self, tree: int, rows: np.ndarray) -> np.ndarray:
        at, every = np.full(len(rows), tree), np.arange(len(rows))
        for _ in range(self.depth):
            f = self.feature[at]
            at = np.where(f < 0, at, self.left[at] + (rows[every, np.maximum(f, 0)] > self.cut[at]))
        return at

    def ends(self, rows: np.ndarray) -> np.ndarray:
        """How many of the rows end in each node."""
        found = np.zeros(len(self.feature), np.int64)
        for t in range(self.trees):
            found += np.bincount(self._leaf(t, rows), minlength=len(found))
        return found

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / that of an unsuccessful search): near 1 is odd.  In steps of 1 / ``SCORE_STEPS``."""
        total = np.zeros(len(rows))
        for t in range(self.trees):
            total += self.length[self._leaf(t, rows)]
        score = 2.0 ** -(total / self.trees / max(float(average_path(self.size)), 1e-9))
        return np.round(score * SCORE_STEPS) / SCORE_STEPS


def average_path(n):
    """Mean length of an unsuccessful search in a binary tree of ``n`` rows (numbers that need not be whole)."""
    n = np.asarray(n, float)
    m = np.maximum(n, 3)
    long = 2 * (np.log(m - 1) + 0.5772156649015329) - 2 * (m - 1) / m
    three = 2 * (np.log(2) + 0.5772156649015329) - 4 / 3
    return np.where(n > 3, long, np.interp(n, [1, 2, 3], [0, 1, three]))


def best_cut(cuts: np.ndarray, good: np.ndarray, bad: np.ndarray, most_lost: float) -> float:
    """``calibrated``, of ascending scores with the good and bad rows that have them."""
    lost = 1 - np.cumsum(good) / max(good.sum(), 1)
    caught = 1 - np.cumsum(bad) / max(bad.sum(), 1)
    return float(cuts[np.argmax(np.where(lost <= most_lost, caught - 10 * lost, -np.inf))])


def calibrated(scores: np.ndarray, good: np.ndarray, most_lost: float) -> float:
    """The threshold above which most bad rows lie for the good rows lost (a good
    one counts as ten), losing no more of these than ``most_lost``."""
    cuts, at = np.unique(scores, return_inverse=True)
    return best_cut(cuts, np.bincount(at[good], minlength=len(cuts)), np.bincount(at[~good], minlength=len(cuts)), most_lost)


def beyond_chance(n: int, rank: int, good: int, bad: int) -> float:
    """The chance that ``n`` bad rows or more lie beyond the good row of that rank from an
    end, were bad ones like good ones: of the first n + rank - 1 rows fewer than ``rank`` are good."""
    tries, q = n + rank - 1, bad / (good + bad)
    return sum(math.exp(math.lgamma(tries + 1) - math.lgamma(j + 1) - math.lgamma(tries - j + 1)
                        + j * math.log(1 - q) + (tries - j) * math.log(q)) for j in range(rank)) if n else 1.0


def tells(good: np.ndarray, bad: np.ndarray, least_auc: float, by_chance: float, tail: float = 0.0025) -> bool:
    """Whether a feature tells good rows from bad ones, given how many of each have its ascending values: by all bad
    rows or by those of a kind that is rare or lies on both sides, beyond the outermost good row, or the
    share ``tail`` of them, of an end."""
    upto, n, m = np.cumsum(good), int(good.sum()), int(bad.sum())
    off = abs((bad * (2.0 * upto - good)).sum() / m / (2 * n) - 0.5)
    chance = 1.0
    for rank in {1, max(1, int(tail * n))}:
        first, last = np.searchsorted(upto, rank), np.searchsorted(upto, n - rank + 1)
        chance = min(chance, *(beyond_chance(int(x), rank, n, m) for x in (bad[:first].sum(), bad[last + 1:].sum())))
    return off >= least_auc or chance < by_chance


def telling(shares: np.ndarray, good: np.ndarray, least_auc: float, by_chance: float = 1e-4, tail: float = 0.0025) -> np.ndarray:
    """The features that tell good rows from bad ones.  All, if none does."""
    kept = []
    for k in range(shares.shape[1] if not good.all() else 0):
        values, at = np.unique(shares[:, k], return_inverse=True)
        counts = [np.bincount(at[x], minlength=len(values)) for x in (good, ~good)]
        if tells(*counts, least_auc, by_chance, tail):
            kept.append(k)
    return np.array(kept) if kept else np.arange(shares.shape[1])


class Judge:
    """Statistics, score and verdict for Arrow text columns."""

    def __init__(self, forest: IsolationForest | None, threshold: float, columns: np.ndarray | None = None):
        self.forest, self.threshold, self.columns = forest, threshold, columns

    def __call__(self, texts: pa.Array) -> dict[str, np.ndarray]:
        stats = statistics(*utf8(texts))
        failed = base_failed(stats["n_words"], stats["n_repeat_words"])
        score = self.forest.scores(features(stats)[:, self.columns]) if self.forest else np.zeros(len(failed))
        return stats | {"base_failed": failed, "anomaly": score, "kept": ~failed & (score <= self.threshold)}


def labelled_features(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``good`` and the features (in steps) of every labelled id (1: good, 0: bad) that passes the base rules,
    written once.  Statistics meet labels; texts stay where they are read."""
    known = (labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label"))
             .filter("label_id is not null and label in (0, 1)").groupBy("label_id").agg(F.min("label").alias("label")))
    df = id_text(docs, id_col, text_col).filter("id is not null")
    schema = T.StructType([df.schema["id"], *(T.StructField(k, T.LongType()) for k in STATISTICS)])

    def count(batches):
        for batch in batches:
            stats = statistics(*utf8(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(stats[k]) for k in STATISTICS)], ["id", *STATISTICS])

    # of a repeated id the least row counts
    rows = (df.mapInArrow(count, schema).join(known, F.col("id") == F.col("label_id"))
            .groupBy("id").agg(F.min(F.struct("label", *STATISTICS)).alias("s")).select("s.*"))
    schema = T.StructType([T.StructField("good", T.BooleanType()), *(T.StructField(f, T.IntegerType()) for f in FEATURES)])

    def steps(batches):
        for batch in batches:
            stats = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in STATISTICS}
            good, found = batch.column("label").to_numpy(zero_copy_only=False) == 1, np.rint(features(stats) * STEPS).astype(np.int32)
            judged = ~base_failed(stats["n_words"], stats["n_repeat_words"])
            yield pa.RecordBatch.from_arrays([pa.array(good[judged]), *(pa.array(found[judged, k]) for k in range(len(FEATURES)))],
                                             schema.names)

    return frozen(rows.mapInArrow(steps, schema), "labelled")


def _shares(batch: pa.RecordBatch, columns) -> tuple[np.ndarray, np.ndarray]:
    good = batch.column(0).to_numpy(zero_copy_only=False)
    return good, np.stack([batch.column(1 + int(k)).to_numpy(zero_copy_only=False) for k in columns], 1) / STEPS


def _summed(rows: DataFrame, tally, size: int) -> np.ndarray:
    """The sum over all batches of ``tally(batch)``, two rows of ``size`` counts whatever the number of rows."""
    def partial(batches):
        total = np.zeros((2, size), np.int64)
        for batch in batches:
            total += tally(batch)
        at = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(total[i, at]) for i in (0, 1))], ["at", "a", "b"])

    found = np.zeros((2, size), np.int64)
    for r in rows.mapInArrow(partial, "at long, a long, b long").groupBy("at").agg(F.sum("a"), F.sum("b")).collect():
        found[:, r[0]] = r[1], r[2]
    return found


def fitted_judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "quality", params: ForestParams = ForestParams()) -> Judge:
    """Fitted on all labelled documents.  What the driver gets are counts by value of a feature, by node of the
    forest and by score, all on fixed grids, so that their number does not grow with the rows."""
    rows = labelled_features(docs, labels, id_col, text_col, label_col)
    values = (rows.select("good", F.posexplode(F.array(*FEATURES)).alias("k", "v")).groupBy("k", "v")
              .agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b")).orderBy("k", "v").collect())
    marginal = [np.array([(r.v, r.g, r.b) for r in values if r.k == k], np.int64).reshape(-1, 3).T for k in range(len(FEATURES))]
    n_good, n_bad = int(marginal[0][1].sum()), int(marginal[0][2].sum())
    if n_good < 2:
        return Judge(None, np.inf)
    columns = [k for k, (_, g, b) in enumerate(marginal) if n_bad and tells(g, b, params.least_auc, params.by_chance)]
    columns = np.array(columns) if columns else np.arange(len(FEATURES))

    def count(forest):
        def tally(batch):
            good, shares = _shares(batch, columns)
            return np.stack([forest.ends(shares[good]), np.zeros(len(forest.feature), np.int64)])
        return _summed(rows, tally, len(forest.feature))[0]

    low, high = (np.array([marginal[k][0][end] for k in columns]) / STEPS for end in (0, -1))
    forest = IsolationForest.counted(low, high, n_good, count, params)

    def tally(batch):
        good, shares = _shares(batch, columns)
        at = np.rint(forest.scores(shares) * SCORE_STEPS).astype(np.int64)
        return np.stack([np.bincount(at[x], minlength=SCORE_STEPS + 1) for x in (good, ~good)])

    by_score = _summed(rows, tally, SCORE_STEPS + 1)
    cuts = np.flatnonzero(by_score.any(0))
    return Judge(forest, best_cut(cuts / SCORE_STEPS, *by_score[:, cuts], params.most_lost), columns)


def judge_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", params: ForestParams = ForestParams()) -> DataFrame:
    """``id_col``, the statistics, ``base_failed``, ``anomaly`` and ``kept``."""
    judge = fitted_judge(docs, labels, id_col, text_col, label_col, params)
    df = id_text(docs, id_col, text_col)
    flags = [T.StructField("base_failed", T.BooleanType()), T.StructField("anomaly", T.DoubleType()),
             T.StructField("kept", T.BooleanType())]
    schema = T.StructType([df.schema["id"], *(T.StructField(k, T.LongType()) for k in STATISTICS), *flags])

    def verdicts(batches):
        for batch in batches:
            found = judge(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[f.name]) for f in schema.fields[1:])],
                                             schema.names)

    return df.mapInArrow(verdicts, schema).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", params: ForestParams = ForestParams()) -> DataFrame:
    """The documents that are kept, all columns as they are."""
    judge = fitted_judge(docs, labels, id_col, text_col, label_col, params)
    text_at = docs.columns.index(text_col)

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(judge(batch.column(text_at).cast(pa.string()))["kept"]))

    return docs.mapInArrow(keep, docs.schema)
