"""Soft-membership mixing: document rates that bring expected domain tokens to target weights.

1. A naive Bayes classifier is trained on labelled documents by grouped counts:
   features are the words with the highest G statistic, whose absence counts as well as
   their presence, and a few binned measures. It gives every document a posterior over the domains.
2. Rates w >= 0 are fitted by projected-gradient least squares. With t the
   tokens of a document and p its posterior, the expected tokens of the domains
   are A = sum(w t p). The objective is the squared distance of A from the
   targets T, weighted by the inverse of M = sum(t p p'). In the metric weighted by
   tokens the gradient step of a document is w - p . inv(M) (A - T), cut at 0. M is
   taken over the documents that are not at 0, since only they can move, so a few steps
   reach the targets, or the point where the rates at 0 allow hardly any less; where such a step does
   not lower the objective, one in the metric of all documents is taken. Starting at w = 1 the rates stay as close to 1 as the targets allow.

All of it is DataFrame functions. An iteration is one aggregate over a few numeric
columns of a written table; only its sums (a few per pair of domains) reach the driver. The
rate of a document is an expression over its posterior and the steps so far. What remains
between targets and expected totals is returned with the rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Store

# white space and punctuation part the words; what is left of them counts as tokens
APART = r"[\x20\x09-\x0D.,;:!?\"()]+"
SYMBOL = "[#*$%&|<>]"


@dataclass(frozen=True)
class Params:
    # domain of a labelled row, in this order; SQL over the columns of the label table
    domains: tuple[tuple[str, str], ...] = (("toxic", "toxic = 1"), ("low", "quality = 0"), ("clean", "quality = 1"))
    # target tokens of each domain: a share of all tokens each (together 1) ...
    shares: dict[str, float] | None = None
    # ... or, without shares, a factor on its present expected tokens
    factors: dict[str, float] = field(default_factory=lambda: {"toxic": 0.25, "low": 0.5, "clean": 1.0})
    sample_rows: int = 20_000        # labelled rows trained on (those with the smallest id hashes)
    vocabulary: int = 40             # words kept as features; weak ones beyond would outvote the strong by their number
    least_docs: int = 5              # labelled documents a word must be in
    least_g: float = 14.0            # G statistic it must reach: by chance about one word in a million does
    pull: float = 20.0               # documents that a feature's overall frequency counts for in each class
    ridge: float = 1e-6              # of each domain's tokens, added to the diagonal of M (it may be singular)
    most_steps: int = 60
    change: float = 1e-6             # stop when every total is this close to its target, as a share of its domain ...
    gain: float = 1e-3               # ... or when no step lowers the objective by this share

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.domains]


def featured(docs: DataFrame) -> DataFrame:
    """docs (of which ``text`` is read) with _n (words), and _f (distinct words and bins; bin names
    hold a space, words never do)."""
    base = docs.withColumn("_t", F.coalesce(F.col("text").cast("string"), F.lit("")))
    base = base.withColumn("_w", F.array_remove(F.split(F.lower("_t"), APART), "")).withColumn("_d", F.array_distinct("_w"))
    base = base.withColumns({"_n": F.size("_w").cast("long"), "_sym": F.size(F.split("_t", SYMBOL)) - 1,
                             "_cap": F.size(F.split("_t", "[A-Z]")) - 1, "_len": F.length("_t")})
    bins = [
        "case when _sym = 0 then 'sym 0' when _sym * 50 <= _n then 'sym 1' else 'sym 2' end",
        "case when _cap * 2 > _len then 'cap 2' when _cap * 5 > _len then 'cap 1' else 'cap 0' end",
        "case when size(_d) * 3 < _n then 'distinct 0' when size(_d) * 2 < _n then 'distinct 1' else 'distinct 2' end",
        "case when _len < 5 * _n then 'length 0' when _len <= 8 * _n then 'length 1' else 'length 2' end",
    ]
    packed = F.concat("_d", F.array(*[F.expr(b) for b in bins]))
    return base.select(*docs.columns, "_n", packed.alias("_f"))


@dataclass
class Classifier:
    names: list[str]
    prior: list[float]                            # log class shares, and of the absence of all words
    weight: dict[str, list[float]]                # feature: what its presence adds to the class's log-likelihood

    def posterior(self) -> Column:
        """P(class | features) as an array column over _f."""
        words = F.array(*[F.lit(w) for w in self.weight]) if self.weight else F.array().cast("array<string>")
        table = F.create_map(*[x for w, v in self.weight.items() for x in (F.lit(w), F.array(*[F.lit(a) for a in v]))])
        zero = F.array(*[F.lit(a) for a in self.prior])
        if not self.weight:
            score = zero
        else:
            score = F.aggregate(F.array_intersect("_f", words), zero,
                                lambda acc, w: F.zip_with(acc, F.element_at(table, w), lambda a, b: a + b))
        top = F.transform(F.array(score), lambda s: F.transform(s, lambda x: F.exp(x - F.array_max(s))))[0]
        return F.transform(F.array(top), lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b)))[0]


def train(docs: DataFrame, labels: DataFrame, params: Params) -> Classifier:
    """Class shares and feature likelihoods from a bounded sample of the labelled documents.

    Likelihoods are drawn towards a feature's frequency in all classes, so that a class with few
    documents says little.
    Rows without doc_id or whose label matches no domain are left out; without any labelled
    document the classes are equally likely and no feature counts.
    """
    names = params.names
    which = F.expr("case " + " ".join(f"when {rule} then {i}" for i, (_, rule) in enumerate(params.domains)) + " end")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), which.alias("_y")).filter("doc_id is not null and _y is not null")
    known = known.groupBy("doc_id").agg(F.min("_y").alias("_y"))
    sample = (known.withColumn("_h", F.xxhash64("doc_id")).orderBy("_h", "doc_id").limit(params.sample_rows).drop("_h"))
    # the sample is bounded by sample_rows, a few bytes a row
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    rows = featured(rows)
    per_class = [F.count_if(F.col("_y") == i).alias(f"n_{i}") for i in range(len(names))]
    # one aggregate: the empty feature counts the documents themselves
    counts = (rows.select("_y", F.explode(F.concat("_f", F.array(F.lit("")))).alias("_f"))
              .groupBy("_f").agg(F.count("*").alias("n"), *per_class))
    total = counts.filter("_f = ''").first()
    if total is None:
        return Classifier(names, [-math.log(len(names))] * len(names), {})
    n = [total[f"n_{i}"] for i in range(len(names))]
    # G statistic of a word's spread over the classes
    g = sum((F.when(F.col(f"n_{i}") > 0, F.col(f"n_{i}") * F.log(F.col(f"n_{i}") * F.lit(float(total.n)) / (F.col("n") * F.lit(float(n[i])))))
             .otherwise(0.0) for i in range(len(names)) if n[i]), F.lit(0.0))
    words = counts.filter((F.col("n") >= params.least_docs) & ~F.col("_f").contains(" ") & (F.col("_f") != "")).withColumn("g", F.round(g, 6)).filter(F.col("g") >= params.least_g)
    chosen = words.orderBy(F.desc("g"), "_f").limit(params.vocabulary).drop("g").unionAll(counts.filter(F.col("_f").contains(" ")))
    prior, weight = [math.log((x + 1) / (total.n + len(names))) for x in n], {}
    for r in chosen.collect():
        p = [(r[f"n_{i}"] + params.pull * r["n"] / total.n) / (n[i] + params.pull) for i in range(len(names))]
        if " " in r["_f"]:                        # of the bins of a measure one always holds
            weight[r["_f"]] = [math.log(x) for x in p]
        else:
            p = [min(x, 1 - 1e-6) for x in p]
            weight[r["_f"]] = [math.log(x / (1 - x)) for x in p]
            prior = [a + math.log(1 - x) for a, x in zip(prior, p)]
    return Classifier(names, prior, weight)


def rate_after(steps: list[list[float]]) -> Column:
    """The rate that these steps lead to, from 1, as an expression over p_0 .. p_k-1.

    The steps are one array literal, so the plan and its code stay the same whatever their number and values.
    """
    if not steps:
        return F.lit(1.0)
    move = lambda step: sum((F.col(f"p_{i}") * step[i] for i in range(len(steps[0]))), F.lit(0.0))
    return F.aggregate(F.lit(steps), F.lit(1.0), lambda rate, step: F.greatest(F.lit(0.0), rate - move(step)))


@dataclass
class Fit:
    steps: list[list[float]]
    target: list[float]
    expected: list[float]

    def gap(self, i: int) -> float | None:
        """What a domain's expected total misses its target by, as a share of it (None for a target of 0)."""
        return self.expected[i] / self.target[i] - 1 if self.target[i] else None


def _state(soft: DataFrame, steps: list[list[float]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected totals at the rates after these steps, and M over the documents not at 0."""
    at = soft.withColumn("_r", rate_after(steps))
    live = F.when(F.col("_r") > 0, F.col("n_tokens")).otherwise(0)
    row = at.agg(*[F.sum(F.col("_r") * F.col("n_tokens") * F.col(f"p_{i}")) for i in range(k)],
                 *[F.sum(live * F.col(f"p_{i}") * F.col(f"p_{j}")) for i in range(k) for j in range(k)]).first()
    values = np.array([x or 0.0 for x in row])
    return values[:k], values[k:].reshape(k, k)


def fit_rates(soft: DataFrame, params: Params) -> Fit:
    """The steps of all iterations. soft: n_tokens, p_0 .. p_k-1 (only these columns are read)."""
    names, k = params.names, len(params.domains)
    held, moment = _state(soft, [], k)
    if params.shares is not None:
        target = np.array([params.shares.get(x, 0.0) for x in names]) * held.sum()
    else:
        target = np.array([params.factors.get(x, 1.0) for x in names]) * held
    ridge = params.ridge * np.diag(held)
    weight = np.linalg.pinv(moment + ridge, rcond=1e-12, hermitian=True)
    cost = lambda total: float((total - target) @ weight @ (total - target))
    steps, expected = [], held
    for _ in range(params.most_steps):
        if all(abs(a - b) <= params.change * h for a, b, h in zip(expected, target, held)):
            break
        # in the metric of the documents that can move, else in that of all of them, in which a step never overshoots
        for metric in (np.linalg.pinv(moment + ridge, rcond=1e-12, hermitian=True), weight):
            trial = [*steps, (metric @ (expected - target)).tolist()]
            total, live = _state(soft, trial, k)
            if cost(total) < cost(expected) * (1 - params.gain):
                break
        else:
            break                                 # what is left is what rates at 0 do not allow
        steps, expected, moment = trial, total, live
    return Fit(steps, target.tolist(), expected.tolist())


def mix(docs: DataFrame, labels: DataFrame, params: Params = Params(), store: Store | None = None,
        carry: list[str] | None = None) -> DataFrame:
    """One row per document: n_tokens (words), p_<domain>, rate, n_copies, gap_<domain>.

    docs: doc_id, text and any further columns, of which ``carry`` (default doc_id) come back.
    labels: doc_id and the columns that the domain rules name. n_copies is the rate rounded up or
    down by a hash of the document, so that its mean is the rate. gap_<domain>, the same on every row, is
    the share by which the domain's expected total (before rounding rates to copies) misses its target. A null text has no tokens: it
    does not move the totals, and its posterior rests on the class shares and its bins. Repeated
    rows and null doc_ids get a row each; an empty table gives no rows.
    """
    st = store or Store(docs.sparkSession, "mixing")
    carry, names = carry or ["doc_id"], params.names
    model = train(docs, labels, params)
    # carried columns travel under numbered names, so that none can clash
    base = docs.select(*[F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(carry)], "doc_id", "text")
    chance = F.pmod(F.xxhash64(F.col("doc_id"), F.col("text"), F.lit(11)), F.lit(1_000_000)) / 1_000_000.0
    soft = featured(base).select("*", model.posterior().alias("_p"), chance.alias("_u"))
    soft = st.put("soft", soft.select(*[f"c_{i}" for i in range(len(carry))], F.col("_n").alias("n_tokens"), "_u",
                                      *[F.round(F.col("_p")[i], 9).alias(f"p_{i}") for i in range(len(names))]))
    fit = fit_rates(soft, params)
    out = soft.withColumn("rate", F.round(rate_after(fit.steps), 6))
    gaps = [fit.gap(i) for i in range(len(names))]
    return out.select(*[F.col(f"c_{i}").alias(c) for i, c in enumerate(carry)], "n_tokens",
                      *[F.col(f"p_{i}").alias(f"p_{n}") for i, n in enumerate(names)], "rate",
                      F.floor(F.col("rate") + F.col("_u")).cast("long").alias("n_copies"),
                      *[F.lit(None if g is None else round(g, 6)).cast("double").alias(f"gap_{n}") for n, g in zip(names, gaps)])


def resample(docs: DataFrame, labels: DataFrame, params: Params = Params(), store: Store | None = None) -> DataFrame:
    """The documents, each as often as its n_copies, with all their columns and nothing else."""
    inner = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    out = mix(inner, labels, params, store, carry=["_row"]).filter("n_copies > 0")
    return out.withColumn("_copy", F.explode(F.expr("sequence(1L, n_copies)"))).select("_row.*")
