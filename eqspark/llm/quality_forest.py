"""Quality rules with an isolation forest over the rules' statistics.

Two fixed rules come first (too few words, too much repetition). Beside them, a forest of random
splits gives each document a mean path length over its statistics; documents that few splits set
apart are anomalous. The score from which a document goes is calibrated on all labelled rows of both classes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, map_rows, ranked, scratch, ship, stored

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
STATISTICS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
FEATURES = 8
#: Thresholds are multiples of one in so many (a power of two, so that a score's cell is exact).
GRID = 1 << 13
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: Longest window key that fits in 63 bits without ranking: distinct words to the power of WINDOW.
_WIDE = int((2**63 - 1) ** (1 / WINDOW))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """The number of words that lie in a window found twice or more."""
    numbers: dict[bytes, int] = {}
    codes = [numbers.setdefault(w, len(numbers)) for w in words]
    n, k = len(words) - window + 1, len(numbers)
    if n < 2 or k == len(words):
        return 0
    code = np.array(codes, np.int64)
    if k <= _WIDE:
        key = code[:n].copy()
        for j in range(1, window):
            key = key * k + code[j : n + j]
    else:  # rank after each step, so that keys stay exact
        key = code[:n]
        for j in range(1, window):
            key = np.unique(key * k + code[j : n + j], return_inverse=True)[1]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    step = np.zeros(len(words) + 1, np.int32)
    np.add.at(step, np.flatnonzero(hit), 1)
    np.add.at(step, np.flatnonzero(hit) + window, -1)
    return int((np.cumsum(step[:-1]) > 0).sum())


def statistics(text: str | None) -> tuple[tuple[int, int, int, int, int], list[float]]:
    """The five base statistics, and the forest's features, of one text."""
    text = text or ""
    data = text.encode()
    words = data.split()
    n = len(words)
    word_chars = len(text) - sum(map(text.count, SPACE))
    letters = len(data) - len(data.translate(None, LETTERS))
    count = lambda chars: len(data) - len(data.translate(None, chars))
    symbols = count(SYMBOLS)
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    repeat = repeated_words(words)
    w, b = max(n, 1), max(len(data), 1)
    features = [symbols / w, dup / max(lines, 1), repeat / w, word_chars / w, count(UPPER) / max(letters, 1), letters / b, count(b"!?") / w, count(b".,;:") / w]
    return (n, word_chars, symbols, dup, repeat), features


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n values."""
    n = np.asarray(n, float)
    m = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(m - 1) + 0.5772156649015329) - 2 * (m - 1) / m, np.where(n == 2, 1.0, 0.0))


class IsolationForest:
    """Random trees, each over a subsample; ``score`` is 2 to the minus mean path over its expectation."""

    def __init__(self, trees: int = 100, subsample: int = 256, seed: int = 7):
        self.trees, self.subsample, self.seed = trees, subsample, seed

    def draws(self, n: int) -> list[np.ndarray]:
        """Each tree's subsample of ``n`` rows, by number."""
        return [np.random.default_rng((self.seed, t)).choice(n, min(self.subsample, n), replace=False) for t in range(self.trees)]

    def fit(self, x: np.ndarray) -> IsolationForest:
        return self.grow([x[d] for d in self.draws(len(x))])

    def grow(self, samples: list[np.ndarray]) -> IsolationForest:
        """A tree over each of ``samples``, which are equally long."""
        rng, size = np.random.default_rng(self.seed), len(samples[0])
        self.depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
        nodes = 2 ** (self.depth + 1) - 1
        self.feature = np.full((self.trees, nodes), -1, np.int32)
        self.split = np.zeros((self.trees, nodes))
        self.path = np.zeros((self.trees, nodes))
        self.norm = float(max(expected_path(size), 1e-9))
        for t, x in enumerate(samples):
            self._grow(t, 0, 0, x, rng)
        return self

    def _grow(self, t: int, node: int, depth: int, x: np.ndarray, rng) -> None:
        low, high = (x.min(0), x.max(0)) if len(x) else (np.zeros(1), np.zeros(1))
        open_ = np.flatnonzero(high > low)
        if depth == self.depth or len(x) < 2 or not len(open_):
            self.path[t, node] = depth + expected_path(len(x))
            return
        f = int(rng.choice(open_))
        at = rng.uniform(low[f], high[f])
        self.feature[t, node], self.split[t, node] = f, at
        self._grow(t, 2 * node + 1, depth + 1, x[x[:, f] < at], rng)
        self._grow(t, 2 * node + 2, depth + 1, x[x[:, f] >= at], rng)

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = self.feature[t, node]
                step = 2 * node + 1 + (x[rows, np.maximum(f, 0)] >= self.split[t, node])
                node = np.where(f < 0, node, step)
            total += self.path[t, node]
        return 2.0 ** (-total / self.trees / self.norm)


def cells(rows: DataFrame, forests: list[tuple[list[int], IsolationForest]], below: tuple[list[int], IsolationForest, float] | None = None) -> np.ndarray:
    """Of each forest (over some features) the number of bad and good rows by cell of their score; with ``below``, of the rows under its threshold.

    All rows are scored, in tasks; what comes back is bounded by ``GRID``.
    """
    shared = rows.sparkSession.sparkContext.broadcast((forests, below))

    def make():
        forests, below = shared.value

        def work(columns):
            x, good = np.array(columns[0]), np.array(columns[1])
            if below is not None:
                left = below[1].score(x[:, below[0]]) < below[2]
                x, good = x[left], good[left]
            out = {"forest": [], "cell": [], "good": [], "n": []}
            for i, (own, forest) in enumerate(forests if len(x) else []):
                found, n = np.unique(2 * (forest.score(x[:, own]) * GRID).astype(np.int64) + good, return_counts=True)
                for name, values in zip(out, ([i] * len(n), found // 2, found % 2, n), strict=True):
                    out[name].extend(map(int, values))
            return out

        return work

    found = map_rows(rows.select("features", "good"), make, "forest int, cell int, good int, n long")
    counts = np.zeros((len(forests), 2, GRID + 1), np.int64)
    for r in found.groupBy("forest", "cell", "good").agg(F.sum("n").alias("n")).collect():
        counts[r["forest"], r["good"], r["cell"]] = r["n"]
    return counts


def calibrate(counts: np.ndarray, allowed: int) -> float:
    """The score from which documents go, so that at most ``allowed`` good rows do; infinite without good rows.

    It lies midway between the cell of the good row that comes next and that of the bad row above it, where there is one.
    """
    bad, good = counts
    held = np.flatnonzero(good)
    if not len(held):
        return float("inf")
    over = np.flatnonzero(np.cumsum(good[::-1])[::-1] > allowed)
    first = int(over[-1] if len(over) else held[0]) + 1
    above = np.flatnonzero(bad[first:])
    return (first + (int(above[0]) // 2 if len(above) else 0)) / GRID


def telling(rows: DataFrame, samples: list[np.ndarray], bad: int, allowed: int) -> list[int]:
    """The features whose forest catches most bad rows, of ``bad`` in all, at this loss of good ones.

    Starting from the best single feature, the most useful one is added again and again; of all the
    sets on this way, the best is taken; a larger one must catch over a hundredth of the bad rows more.
    """
    features, best, most = [], [], float("-inf")
    while len(features) < FEATURES:
        sets = [[*features, k] for k in range(FEATURES) if k not in features]
        counts = cells(rows, [(own, IsolationForest(len(samples)).grow([x[:, own] for x in samples])) for own in sets])
        caught = [int(c[0][int(min(calibrate(c, allowed), 2) * GRID) :].sum()) for c in counts]
        n, more = max((n, -own[-1]) for n, own in zip(caught, sets, strict=True))
        features = [*features, -more]
        if n > most + 0.01 * bad:
            best, most = features, n
    return best


class QualityModel:
    """Fitted forests. A document stays when it is below ``threshold`` in ``forest``, which sees all
    features, and below that of ``telling`` (features, forest, threshold), if there is one."""

    def __init__(self, forest: IsolationForest | None, threshold: float, telling: tuple[list[int], IsolationForest, float] | None = None):
        self.forest, self.threshold, self.telling = forest, threshold, telling

    def keeps(self, features: list[list[float]]) -> list[bool]:
        if self.forest is None or not features:
            return [True] * len(features)
        x = np.array(features)
        kept = self.forest.score(x) < self.threshold
        if self.telling is not None:
            own, forest, threshold = self.telling
            kept &= forest.score(x[:, own]) < threshold
        return kept.tolist()


def measure(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The base statistics, ``base_failed`` and the forests' features of every row, over whole texts."""

    def make():
        def work(columns):
            found = [statistics(t) for t in columns[1]]
            n, chars, symbols, dup, repeat = map(list, zip(*(s for s, _ in found), strict=True))
            failed = [base_failed(a, b) for a, b in zip(n, repeat, strict=True)]
            return {"doc_id": columns[0], "n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeat, "base_failed": failed, "features": [f for _, f in found]}

        return work

    return map_rows(docs.select(F.col(id_column).cast("long"), F.col(text_column)), make, f"{STATISTICS}, features array<double>")


def fit(docs: DataFrame, labels: DataFrame, trees: int = 200, subsample: int = 32, max_false_reject: float = 0.002) -> QualityModel:
    """``fit_measured`` for documents that are not measured yet; all are, so that no text is shuffled."""
    with scratch(docs.sparkSession):
        return fit_measured(stored(measure(docs), "quality-measured"), labels, trees, subsample, max_false_reject)


def fit_measured(measured: DataFrame, labels: DataFrame, trees: int = 200, subsample: int = 32, max_false_reject: float = 0.002) -> QualityModel:
    """Fit on all labelled documents, of which ``measured`` has what ``measure`` gives (a stored table).

    ``labels`` has ``doc_id, quality`` (1 good, 0 bad); rows with a null are left out. Documents that
    the fixed rules reject take no part. As isolation forests do, each tree draws its own rows, here of all
    labelled ones; features and thresholds are chosen by counts over all of them. Subsamples are small, as
    anomalous documents are many and alike: in large ones they would hide one another. Both classes set the
    thresholds: a first forest has the features that tell most of the bad rows from the good; one over all
    features, for what the labels don't show, may reject what is left of ``max_false_reject``, the share of
    good rows that may go in all. With no labelled documents the forests reject nothing.
    """
    spark = measured.sparkSession
    chosen = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))
    with scratch(spark):
        rows = measured.where("not base_failed").join(chosen, "doc_id").select("doc_id", F.xxhash64("doc_id").alias("hash"), "good", "features")
        rows = stored(rows, "quality-labelled")
        n, n_good = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0))).first()
        if not n:
            return QualityModel(None, float("inf"))
        forest = IsolationForest(trees, subsample)
        draws = forest.draws(n)
        placed, rank = ranked(rows, ["hash", "doc_id", "features"], "quality-ranked")
        wanted = spark.createDataFrame([(int(i),) for i in np.unique(np.concatenate(draws))], f"{rank} long")  # at most trees * subsample
        x = {r[0]: r[1] for r in placed.join(F.broadcast(wanted), rank).select(rank, "features").collect()}
        samples = [np.array([x[int(i)] for i in d]) for d in draws]
        forest.grow(samples)
        allowed, first = int(max_false_reject * n_good), None
        if 0 < n_good < n:
            own = telling(rows, samples[: max(trees // 4, 1)], n - n_good, allowed)
            narrow = IsolationForest(trees, subsample).grow([s[:, own] for s in samples])
            counts = cells(rows, [(own, narrow)])[0]
            first = (own, narrow, calibrate(counts, allowed))
            allowed -= int(counts[1][int(first[2] * GRID) :].sum())
        return QualityModel(forest, calibrate(cells(rows, [(list(range(FEATURES)), forest)], first)[0], allowed), first)


def judge(measured: DataFrame, model: QualityModel) -> DataFrame:
    """What ``assess`` returns, of documents that are measured."""
    shared = measured.sparkSession.sparkContext.broadcast(model)

    def make():
        keeps, names = shared.value.keeps, [c.split()[0] for c in STATISTICS.split(", ")]

        def work(columns):
            kept = [k and not f for k, f in zip(keeps(columns[-1]), columns[-2], strict=True)]
            return dict(zip(names, columns[:-1], strict=True)) | {"kept": kept}

        return work

    return map_rows(measured, make, f"{STATISTICS}, kept boolean")


def assess(docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The base statistics, ``base_failed`` and ``kept`` of every row, over whole texts.

    A null text has no words, lines or symbols, so the base rules reject it, as they do the empty text.
    Repeated rows and ties get equal verdicts; null ids stay; an empty table gives no rows.
    """
    return judge(measure(docs, id_column, text_column), model)


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` without the rejected rows; every column passes through unchanged, whatever its name.

    Null and empty texts are rejected; repeated rows and ties have equal verdicts; null identifiers stay;
    an empty table stays empty.
    """
    import pyarrow as pa

    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches):
        keeps = shared.value.keeps
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = [statistics(t.as_py()) for t in part.column(place)]
                mask = [k and not base_failed(s[0], s[4]) for k, (s, _) in zip(keeps([f for _, f in found]), found, strict=True)]
                yield part.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
