"""Quality rules by weak supervision, with DataFrame functions only.

Each rule votes keep (1), drop (-1) or abstains (0) on a document's measures. No
single rule rejects; a label model weighs them: expectation-maximisation over
the vote patterns estimates every rule's accuracy on good and on bad documents
(one latent class, votes independent given it), and a document's posterior
probability of being good decides. Abstentions carry no evidence.

The measures are taken in one pass over the texts and written once, a few
numbers per document. EM runs over the counts of vote patterns (at most
3 ** rules rows, whatever the number of documents); an iteration is one
aggregate, of which only its sums reach the driver, and they go back into the
next iteration as literals.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Store

SPACES = r"[\x20\x09-\x0D]+"
WHITE = "\\\\x20\\\\x09-\\\\x0D"      # inside a SQL string
SYMBOLS = "#*$%&|<>"
# Very frequent function words of the corpus languages.
FUNCTION_WORDS = (
    "the and of to a in that is was for it as be with by on not he his but at are this "
    "der die das und in zu den von mit sich des auf für ist im dem nicht ein eine als auch es an "
    "le la les de des et un une en du que est pour qui dans par au sur plus "
    "el los las y por con una su para es se del lo al"
).split()


@dataclass(frozen=True)
class Rule:
    """keep / drop: SQL conditions over the measures; neither: abstain."""
    name: str
    keep: str
    drop: str


RULES = (
    Rule("symbols", "n_symbols * 50 <= n_words", "n_symbols * 10 >= n_words"),
    Rule("symbol_share", "n_symbols * 500 <= word_chars", "n_symbols * 50 >= word_chars"),
    Rule("function_words", "n_function * 20 >= n_words", "n_function * 50 <= n_words"),
    Rule("distinct_words", "n_distinct * 2 >= n_words", "n_distinct * 10 <= n_words * 3"),
    Rule("repeated_windows", "n_repeat_words * 5 <= n_words", "n_repeat_words * 10 >= n_words * 3"),
    Rule("repeated_lines", "n_dup_lines * 10 <= n_lines and n_lines >= 4", "n_dup_lines * 2 >= n_lines and n_dup_lines >= 3"),
    Rule("word_length", "word_chars >= 4 * n_words and word_chars <= 6.5 * n_words", "word_chars <= 3 * n_words or word_chars >= 9 * n_words"),
    Rule("capitals", "n_capitals * 5 <= word_chars", "n_capitals * 2 >= word_chars"),
    Rule("exclamations", "n_exclaim * 50 <= n_words", "n_exclaim * 4 >= n_words"),
    Rule("length", "n_words >= 50", "n_words < 10"),
)


@dataclass(frozen=True)
class Params:
    rules: tuple[Rule, ...] = RULES
    threshold: float = 0.5           # keep at this posterior or more
    prior_good: float = 0.5          # start of the class share
    right_good: float = 0.98         # prior mean of P(keep | votes, good): few rules object to a good document
    right_bad: float = 0.3           # prior mean of P(drop | votes, bad): a bad one breaks some rules, not all
    weight: float = 20.0             # votes that a prior counts for
    most_steps: int = 200
    change: float = 1e-6             # stop when no parameter moves by more
    function_words: tuple[str, ...] = field(default=tuple(FUNCTION_WORDS))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_function", "n_distinct",
            "n_capitals", "n_exclaim")


def _count(text: str, chars: str) -> str:
    """SQL for the number of characters of a class in a text (the parts around them, less one)."""
    return f"cast(size(split({text}, '[{chars}]')) - 1 as long)"


def _repeat_words(windows: str) -> str:
    """SQL for the words covered by 8-word windows found twice, from the array of window hashes.

    Only texts with a repeated hash go on: (hash, position) pairs are sorted, positions whose
    neighbour has the same hash are kept, and the covered words follow from their gaps. A
    one-element transform binds a value to a name, so that it is computed once.
    """
    flagged = ("sort_array(transform(filter(sequence(0, size(s) - 1), j -> coalesce(get(s, j).h = get(s, j - 1).h, false) "
               "or coalesce(get(s, j).h = get(s, j + 1).h, false)), j -> get(s, j).i))")
    covered = ("8 + aggregate(zip_with(slice(p, 2, size(p) - 1), slice(p, 1, size(p) - 1), (b, a) -> least(8, b - a)), "
               "0, (total, x) -> total + x)")
    return (f"cast(case when size({windows}) > size(array_distinct({windows})) then "
            f"transform(transform(array(sort_array(transform({windows}, (h, i) -> named_struct('h', h, 'i', i)))), s -> {flagged}), "
            f"p -> {covered})[0] else 0 end as long)")


def measures(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """docs with the measures of its texts appended as ``_m`` (a struct of MEASURES); null counts as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.withColumn("_t", text)
    base = base.withColumn("_w", F.array_remove(F.split("_t", SPACES), ""))
    parts = ", ".join(f"get(_w, i + {j})" for j in range(8))
    base = base.withColumn("_h", F.expr(
        f"case when size(_w) >= 8 then transform(sequence(0, size(_w) - 8), i -> xxhash64({parts})) else cast(array() as array<bigint>) end"))
    base = base.withColumn("_l", F.expr(f"filter(split(_t, '\\n'), x -> x rlike '[^{WHITE}]')"))
    words = ", ".join(f"'{w}'" for w in dict.fromkeys(params.function_words))
    fields = {
        "n_words": "cast(size(_w) as long)",
        "word_chars": f"length(_t) - {_count('_t', WHITE)}",
        "n_symbols": _count("_t", SYMBOLS),
        "n_dup_lines": "cast(size(_l) - size(array_distinct(_l)) as long)",
        "n_repeat_words": _repeat_words("_h"),
        "n_lines": "cast(size(_l) as long)",
        "n_function": f"cast(size(filter(_w, x -> lower(x) in ({words}))) as long)",
        "n_distinct": "cast(size(array_distinct(_w)) as long)",
        "n_capitals": _count("_t", "A-Z"),
        "n_exclaim": _count("_t", "!"),
    }
    packed = F.struct(*[F.expr(e).alias(n) for n, e in fields.items()])
    return base.select(*docs.columns, packed.alias("_m"))


def votes(params: Params) -> list[Column]:
    """One vote column per rule, named v_<rule>."""
    return [F.expr(f"case when {r.drop} then -1 when {r.keep} then 1 else 0 end").alias(f"v_{r.name}") for r in params.rules]


@dataclass
class Model:
    """Class share and, per rule, the probability of a right vote on good and on bad documents."""
    good: float
    right_good: dict[str, float]
    right_bad: dict[str, float]

    def posterior(self) -> Column:
        """P(good | votes) as a column over v_<rule>."""
        # one array literal of what the votes -1, 0, 1 of each rule add, so that an iteration's plan and code stay the same
        weights = []
        for i, (name, a) in enumerate(self.right_good.items()):
            b, base = self.right_bad[name], math.log(self.good / (1 - self.good)) if i == 0 else 0.0
            weights += [base + math.log((1 - a) / b), base, base + math.log(a / (1 - b))]
        votes = [F.get(F.lit(weights), F.lit(3 * i + 1) + F.col(f"v_{name}")) for i, name in enumerate(self.right_good)]
        return 1 / (1 + F.exp(-sum(votes[1:], votes[0])))


def fit(patterns: DataFrame, params: Params) -> Model:
    """EM over the counts of vote patterns (columns v_<rule>, n).

    Accuracies have Beta priors, and a rule never drops a good document more readily than a bad
    one, so that the classes cannot swap names. Without documents the priors stay as they are.
    """
    names = [r.name for r in params.rules]
    model = Model(params.prior_good, {r: params.right_good for r in names}, {r: params.right_bad for r in names})
    for _ in range(params.most_steps):
        q, n = F.col("q"), F.col("n")
        sums = [F.sum(n).alias("n"), F.sum(n * q).alias("good")]
        for r in names:
            v = F.col(f"v_{r}")
            sums += [F.sum(F.when(v == 1, n * q).otherwise(0.0)).alias(f"gk_{r}"), F.sum(F.when(v == -1, n * q).otherwise(0.0)).alias(f"gd_{r}"),
                     F.sum(F.when(v == 1, n * (1 - q)).otherwise(0.0)).alias(f"bk_{r}"), F.sum(F.when(v == -1, n * (1 - q)).otherwise(0.0)).alias(f"bd_{r}")]
        s = patterns.withColumn("q", model.posterior()).agg(*sums).first()
        if not s.n:
            break

        def rate(right: float, wrong: float, prior: float) -> float:
            value = (right + prior * params.weight) / (right + wrong + params.weight)
            return min(max(value, 0.0001), 0.9999)

        good = {r: rate(s[f"gk_{r}"], s[f"gd_{r}"], params.right_good) for r in names}
        bad = {r: max(rate(s[f"bd_{r}"], s[f"bk_{r}"], params.right_bad), 1 - good[r]) for r in names}
        new = Model(min(max(s.good / s.n, 0.001), 0.999), good, bad)
        moved = max([abs(new.good - model.good), *(abs(new.right_good[r] - model.right_good[r]) for r in names),
                     *(abs(new.right_bad[r] - model.right_bad[r]) for r in names)])
        model = new
        if moved < params.change:
            break
    return model


def judge(docs: DataFrame, params: Params = Params(), store: Store | None = None, carry: list[str] | None = None) -> DataFrame:
    """One row per document with its base measures, posterior and verdict.

    docs: doc_id, text and any further columns. Returns the columns ``carry`` (default doc_id),
    the measures, v_<rule>, base_failed (n_words < 20, or over 30 % of the words in repeated
    8-word windows), p_good, kept (not base_failed and p_good at the threshold or more). A null
    text counts as empty and fails the base; repeated rows and null doc_ids get a row each; an
    empty table gives no rows.
    """
    st = store or Store(docs.sparkSession, "quality")
    carry = carry or ["doc_id"]
    # carried columns travel under numbered names, so that none can clash
    base = docs.select(*[F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(carry)], "text")
    measured = st.put("measures", measures(base, params).select(*[f"c_{i}" for i in range(len(carry))], "_m.*").select("*", *votes(params)))
    patterns = st.put("patterns", measured.groupBy(*[f"v_{r.name}" for r in params.rules]).agg(F.count("*").alias("n")).coalesce(1))
    model = fit(patterns, params)
    failed = F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")
    out = measured.withColumns({"base_failed": failed, "p_good": F.round(model.posterior(), 9)})
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= params.threshold))
    rest = [c for c in out.columns if not c.startswith("c_")]
    return out.select(*[F.col(f"c_{i}").alias(c) for i, c in enumerate(carry)], *rest)


def filter_quality(docs: DataFrame, params: Params = Params(), store: Store | None = None) -> DataFrame:
    """The documents that the label model keeps, with all their columns and nothing else."""
    inner = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return judge(inner, params, store, carry=["_row"]).filter("kept").select("_row.*")
