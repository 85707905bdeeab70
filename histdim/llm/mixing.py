"""Mixing documents to target domain weights, by DataFrame functions alone.

1.  A classifier (Bernoulli naive Bayes over the words that tell a domain best) is
    fitted on a bounded sample of a labelled table.  Its weights, some hundred rows, become
    literals, and every document gets its posterior over the domains.
2.  A document with ``t`` tokens and posterior ``p`` taken at rate ``r`` brings
    ``r t p[d]`` expected tokens to domain ``d``.  Projected gradient descent on the
    squared misfit of the domain totals finds rates r >= 0: a step is one aggregation to a
    number per domain, ``r <- max(0, r - p . g)`` with ``g`` the residual of the totals
    scaled by the inverse of sum(t p p') over the documents with r > 0.  (This is the
    gradient in the metric that weighs a document by its tokens.)  A rate depends on the document's posterior and
    the gradients so far, so no state is kept and nothing is shuffled.
3.  A rate is made a number of copies by its whole part and a hash of the document
    held against the rest, so that expected totals stay.

Cases: a null or empty text has no tokens, the prior as its posterior, and a rate like any other;
a null id takes no part in fitting; repeated rows get the same posterior and rate; without
labels all posteriors are equal; domains without any expected tokens can't be raised
and are left out of the targets; an empty table gives no rows; further columns are ignored or kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histdim.llm.frames import stored


@dataclass(frozen=True)
class MixParams:
    """``fit_rows``: the most labelled rows that the classifier is fitted on;
    ``terms``: words per domain; ``least_docs``: a word's documents in the sample, at
    least; the descent ends after ``steps``, at a largest misfit of ``misfit`` (share of all
    tokens), or when no step shortens the residual by ``gain``."""

    fit_rows: int = 10_000
    terms: int = 64
    least_docs: int = 8
    steps: int = 40
    misfit: float = 1e-6
    gain: float = 0.01


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+``."""
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), "")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once, however often it is used there."""
    return F.transform(F.array(value), then)[0]


# --- the classifier ---------------------------------------------------------------


@dataclass(frozen=True)
class DomainModel:
    """``base``: by domain; ``weights``: by word, then by domain."""

    domains: tuple[str, ...]
    base: tuple[float, ...]
    weights: Mapping[str, tuple[float, ...]] = field(default_factory=dict)

    def posterior(self, words: Column) -> Column:
        """The array of the domains' probabilities."""
        base = F.array(*[F.lit(float(x)) for x in self.base])
        if self.weights:
            vocabulary = F.array(*[F.lit(w) for w in self.weights])
            table = F.create_map(*[x for w, v in self.weights.items() for x in (F.lit(w), F.array(*map(F.lit, map(float, v))))])
            logs = F.aggregate(F.array_intersect(words, vocabulary), base,
                               lambda sums, w: F.zip_with(sums, F.element_at(table, w), lambda a, b: a + b))
        else:
            logs = base
        return let(let(let(logs, lambda x: F.struct(x.alias("logs"), F.array_max(x).alias("most"))),
                       lambda s: F.transform(s["logs"], lambda x: F.exp(x - s["most"]))),
                   lambda raised: let(F.aggregate(raised, F.lit(0.0), lambda a, b: a + b),
                                      lambda total: F.transform(raised, lambda x: x / total)))


def fit_domains(docs: DataFrame, labelled: DataFrame, domains: Sequence[str], id_col: str = "doc_id",
                text_col: str = "text", domain_col: str = "domain", params: MixParams = MixParams()) -> DomainModel:
    """Fitted on the ``params.fit_rows`` labelled ids that hash lowest."""
    domains = tuple(domains)
    sample = (labelled.select(F.col(id_col).alias("label_id"), F.col(domain_col).alias("domain"))
              .filter(F.col("label_id").isNotNull() & F.col("domain").isin(*domains))
              .groupBy("label_id").agg(F.min("domain").alias("domain"))
              .orderBy(F.xxhash64("label_id"), "label_id").limit(params.fit_rows))
    mine = docs.select(F.col(id_col).alias("id"), F.array_distinct(words_of(F.col(text_col))).alias("words")).join(
        F.broadcast(sample), F.col("id") == F.col("label_id"))
    of = [F.sum((F.col("domain") == d).cast("long")).alias(f"n{i}") for i, d in enumerate(domains)]
    # The empty word, which no text has, counts the documents.
    counts = stored(mine.select("domain", F.explode(F.concat("words", F.array(F.lit("")))).alias("word"))
                    .groupBy("word").agg(F.count("*").alias("n"), *of)
                    .filter((F.col("n") >= params.least_docs) | (F.col("word") == "")), "words")
    every = counts.filter("word = ''").first()
    if every is None:
        return DomainModel(domains, (0.0,) * len(domains))
    total, size = every["n"], [every[f"n{i}"] for i in range(len(domains))]
    chosen = {}
    for i in range(len(domains)):
        a, n = F.col(f"n{i}").cast("double"), F.col("n").cast("double")
        even = n * (size[i] / total)      # had the word nothing to do with the domain
        chi = F.when((even > 0) & (even < n) & (n < total),
                     (a - even) ** 2 * total / (even * (1 - size[i] / total) * (total - n))).otherwise(0.0)
        best = counts.filter("word != ''").orderBy(chi.desc(), "word").limit(params.terms).collect()
        chosen |= {r["word"]: [r[f"n{k}"] for k in range(len(domains))] for r in best}
    share = {w: [(n + 1) / (size[k] + 2) for k, n in enumerate(v)] for w, v in sorted(chosen.items())}
    prior = [math.log((n + 1) / (total + len(domains))) for n in size]
    return DomainModel(domains, tuple(p + sum(math.log1p(-s[k]) for s in share.values()) for k, p in enumerate(prior)),
                       {w: tuple(math.log(x) - math.log1p(-x) for x in s) for w, s in share.items()})


# --- the rates ----------------------------------------------------------------------


def _solve(m: list[list[float]], y: list[float]) -> list[float]:
    """m x = y by elimination; a domain without tokens gets 0."""
    n = len(y)
    a = [[*row, v] for row, v in zip(m, y)]
    small = 1e-12 * max((m[i][i] for i in range(n)), default=0.0)
    free = []
    for c in range(n):
        p = max((r for r in range(n) if r not in free), key=lambda r: abs(a[r][c]), default=None)
        if p is None or abs(a[p][c]) <= small:
            continue
        free.append(p)
        for r in range(n):
            if r != p and a[r][c]:
                k = a[r][c] / a[p][c]
                a[r] = [x - k * z for x, z in zip(a[r], a[p])]
    x = [0.0] * n
    for p in free:
        c = next(i for i in range(n) if abs(a[p][i]) > small)
        x[c] = a[p][n] / a[p][c]
    return x


@dataclass(frozen=True)
class Rates:
    """The descent's gradients: a document's rate follows from its posterior."""

    domains: tuple[str, ...]
    goals: tuple[float, ...]
    gradients: tuple[tuple[float, ...], ...]
    reached: tuple[float, ...]

    def column(self, posterior: Column) -> Column:
        """The rate of a document with this array of probabilities, by the gradients
        one after the other."""
        if not self.gradients:
            return F.lit(1.0)
        steps = F.array(*[F.array(*[F.lit(float(x)) for x in g]) for g in self.gradients])
        return let(posterior, lambda p: F.aggregate(steps, F.lit(1.0), lambda rate, g: F.greatest(
            F.lit(0.0), rate - sum((p[i] * g[i] for i in range(len(self.domains))), F.lit(0.0)))))


def fit_rates(shares: DataFrame, domains: Sequence[str], targets: Mapping[str, float], whole: Sequence[str] = (),
              headroom: float = 0.0, params: MixParams = MixParams(), most: Mapping[str, float] = {}) -> Rates:
    """``shares`` has ``tokens`` and p0, p1, ... by domain.  The goals are ``targets``
    (scaled to 1) of a total: that of all tokens, or where domains are to stay
    ``whole``, the least at which none of these falls below its expected tokens times 1 + ``headroom``.
    A domain in ``most`` has that share of its expected tokens as its goal at most, so that
    a rare one isn't multiplied to meet its target."""
    n = len(domains)
    p = [F.col(f"p{i}") for i in range(n)]
    t = F.col("tokens").cast("double")
    first = shares.agg(*[F.sum(t * p[i]).alias(f"e{i}") for i in range(n)],
                       *[F.sum(t * p[i] * p[j]).alias(f"m{i}_{j}") for i in range(n) for j in range(i, n)]).first()
    have = [first[f"e{i}"] or 0.0 for i in range(n)]
    weight = [targets.get(d, 0.0) if have[i] > 0 else 0.0 for i, d in enumerate(domains)]
    scale = sum(weight)
    if not scale:
        return Rates(tuple(domains), tuple(have), (), tuple(have))
    weight = [w / scale for w in weight]
    total = max((have[i] * (1 + headroom) / weight[i] for i, d in enumerate(domains) if d in whole and weight[i]), default=sum(have))
    goals = [min(w * total, most[d] * have[i]) if d in most else w * total for i, (d, w) in enumerate(zip(domains, weight))]
    m = [[first[f"m{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(n)] for i in range(n)]
    done, now = Rates(tuple(domains), tuple(goals), (), tuple(have)), m

    def misfit(reached: Sequence[float]) -> float:
        return max(abs(x - y) for x, y in zip(reached, goals))

    def length(reached: Sequence[float]) -> float:      # of the residual, in the metric that descent shortens
        off = [x - y for x, y in zip(reached, goals)]
        return math.sqrt(max(0.0, sum(x * y for x, y in zip(off, _solve(m, off)))))

    def tried(step: Sequence[float]) -> tuple[Rates, list[list[float]]]:
        gradients = (*done.gradients, tuple(step))
        rate = Rates(done.domains, done.goals, gradients, ()).column(F.array(*p))
        rated = shares.withColumn("rate", rate)
        taken = (F.col("rate") > 0).cast("double")
        row = rated.agg(*[F.sum(t * p[i] * F.col("rate")).alias(f"e{i}") for i in range(n)],
                        *[F.sum(t * p[i] * p[j] * taken).alias(f"m{i}_{j}") for i in range(n) for j in range(i, n)]).first()
        reached = tuple(row[f"e{i}"] or 0.0 for i in range(n))
        return (Rates(done.domains, done.goals, gradients, reached),
                [[row[f"m{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(n)] for i in range(n)])

    while len(done.gradients) < params.steps and misfit(done.reached) > params.misfit * total:
        off = [x - y for x, y in zip(done.reached, goals)]
        for metric in (now, m):      # of the documents still taken, or else of all
            new, then = tried(_solve(metric, off))
            if length(new.reached) <= (1 - params.gain) * length(done.reached):
                done, now = new, then
                break
        else:      # the targets are out of reach
            break
    return done


def mixed(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], id_col: str = "doc_id",
          text_col: str = "text", domain_col: str = "domain", whole: Sequence[str] = (), headroom: float = 0.0,
          params: MixParams = MixParams(), most: Mapping[str, float] = {}) -> DataFrame:
    """``row``, a struct of all columns of ``docs``, so that no name can clash, and ``mix``: tokens, posterior
    (array in the order of sorted(targets)), rate, copies."""
    domains = tuple(sorted(targets))
    model = fit_domains(docs, labelled, domains, id_col, text_col, domain_col, params)

    def judged(with_words: Callable[[Column, Column], Column]) -> Column:
        """``with_words(tokens, posterior)`` of a document."""
        return let(words_of(F.col(text_col)), lambda words: let(
            model.posterior(words), lambda p: with_words(F.size(words).cast("long"), p)))

    # Documents alike in posterior count as one row: what is iterated over.
    shares = docs.select(judged(lambda n, p: F.struct(n.alias("tokens"), p.alias("p"))).alias("d")).select(
        "d.tokens", *[F.col("d.p")[i].alias(f"p{i}") for i in range(len(domains))])
    shares = stored(shares.groupBy(*shares.columns[1:]).agg(F.sum("tokens").alias("tokens")), "shares")
    rates = fit_rates(shares, domains, targets, whole, headroom, params, most)
    chance = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def mix(tokens: Column, p: Column) -> Column:
        def with_rate(rate: Column) -> Column:
            copies = F.floor(rate) + F.when(chance < rate - F.floor(rate), F.lit(1)).otherwise(F.lit(0))
            return F.struct(tokens.alias("tokens"), p.alias("posterior"), rate.alias("rate"),
                            copies.cast("long").alias("copies"))

        return let(rates.column(p), with_rate)

    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), judged(mix).alias("mix"))


def document_rates(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], id_col: str = "doc_id",
                   text_col: str = "text", domain_col: str = "domain", **options) -> DataFrame:
    """``id_col``, ``n_tokens``, ``p_<domain>``, ``rate``, ``n_copies``."""
    out = mixed(docs, labelled, targets, id_col, text_col, domain_col, **options)
    return out.select(F.col("row")[id_col].alias(id_col), F.col("mix.tokens").alias("n_tokens"),
                      *[F.col("mix.posterior")[i].alias(f"p_{d}") for i, d in enumerate(sorted(targets))],
                      F.col("mix.rate").alias("rate"), F.col("mix.copies").alias("n_copies"))


def mixture(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], id_col: str = "doc_id",
            text_col: str = "text", domain_col: str = "domain", once: bool = False, **options) -> DataFrame:
    """The documents, each as often as its rate says (``once``: at most once); all columns as they are."""
    out = mixed(docs, labelled, targets, id_col, text_col, domain_col, **options).filter("mix.copies > 0")
    if not once:
        out = out.select("row", F.explode(F.sequence(F.lit(1), F.col("mix.copies"))))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns])
