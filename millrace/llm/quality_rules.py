"""Quality by weak supervision: rules vote or abstain, EM estimates their accuracies, the posterior decides.

A document is good or bad; which is not observed. Each rule votes good (1), bad (-1) or abstains (0). Of rule j two
error rates are estimated: how often it votes bad on bad documents, and how often on good ones. Rules are taken as
independent given the class, and an abstention says nothing. Documents with the same votes are alike to the model,
so EM runs on the counts per vote pattern, of which there are at most 3 to the number of rules however many
documents there are. All of it is DataFrame expressions; the driver sees one row of rates per EM step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import SPACE, WORD, free_names, ready, whole_text
from millrace.session import scratch_path
from millrace.sources import expanded

WINDOW = 5
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (*BASE, "n_lines", "n_upper", "n_distinct")


@dataclass(frozen=True)
class Rule:
    """Votes bad beyond `bad`, good within `good`, both SQL conditions over FEATURES; else it abstains."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("symbols", "n_symbols * 10 > n_words", "n_symbols * 50 <= n_words"),
    Rule("capitals", "n_upper * 10 > word_chars * 3", "n_upper * 10 <= word_chars"),
    Rule("repeats", "n_repeat_words * 10 > n_words", "n_repeat_words * 50 <= n_words"),
    Rule("lines", "n_dup_lines * 4 > n_lines", "n_dup_lines = 0"),
    Rule("word_length", "word_chars > n_words * 15 or word_chars < n_words * 2", "word_chars between n_words * 3 and n_words * 10"),
    Rule("diversity", "n_words >= 50 and n_distinct * 8 < n_words", "n_distinct * 3 > n_words"),
)
# EM steps, and the bounds of the estimated rates: no rule is ever taken as free of error.
STEPS = 10
FLOOR, CEILING = 0.02, 0.98
PLACES = 9


def text_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with FEATURES of the whole text as BIGINT columns.

    Words repeated in windows: the windows' hashes say quickly that a text has no window twice, which is true for
    most; the others are decided on the words themselves.
    """
    t_, w_, lines_, h_, s_, at_ = free_names(docs, "_t", "_w", "_lines", "_h", "_s", "_at")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in FEATURES]
    t = docs.select(*kept, whole_text(text).alias(t_))
    t = t.select(
        *kept,
        F.array_remove(F.split(t_, f"[{SPACE}]+"), "").alias(w_),
        F.filter(F.split(t_, "\n"), lambda line: line.rlike(WORD)).alias(lines_),
        F.regexp_count(t_, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(t_, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
    )
    starts = F.when(F.size(w_) >= WINDOW, F.sequence(F.lit(0), F.size(w_) - WINDOW)).otherwise(
        F.array().cast("array<int>")
    )
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w_, i + at) for at in range(WINDOW)]))
    counted = [
        F.size(w_).cast("long").alias("n_words"),
        F.length(F.array_join(w_, "")).cast("long").alias("word_chars"),
        F.size(lines_).cast("long").alias("n_lines"),
        (F.size(lines_) - F.size(F.array_distinct(lines_))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(w_)).cast("long").alias("n_distinct"),
    ]
    t = t.select(*kept, w_, "n_symbols", "n_upper", *counted, hashes.alias(h_))
    windows = F.transform(
        F.sequence(F.lit(0), F.size(w_) - WINDOW),
        lambda i: F.struct(F.array_join(F.slice(w_, i + 1, WINDOW), " ").alias("words"), i.alias("at")),
    )
    repeated = F.size(F.array_distinct(h_)) < F.size(h_)
    numbers = [F.col(c) for c in FEATURES if c != "n_repeat_words"]
    t = t.select(*kept, *numbers, F.when(repeated, F.array_sort(windows)).alias(s_))

    def twice(window: Column, i: Column) -> Column:
        before, after = F.get(s_, i - 1)["words"], F.get(s_, i + 1)["words"]
        return F.coalesce(before == window["words"], F.lit(False)) | F.coalesce(after == window["words"], F.lit(False))

    found = F.array_sort(F.transform(F.filter(s_, twice), lambda window: window["at"]))
    t = t.select(*kept, *numbers, found.alias(at_))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        at_,
        zero,
        lambda s, at: F.struct(
            (at + WINDOW).alias("end"), (s["n"] + at + WINDOW - F.greatest(at, s["end"])).cast("long").alias("n")
        ),
    )["n"]
    # A generator, so that Catalyst does not move a filter on the features, and with it all of the above, below it.
    repeats = F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words")
    return t.select(*kept, expanded(F.struct(*numbers, repeats)))


def vote(rule: Rule) -> Column:
    return F.when(F.expr(rule.bad), -1).when(F.expr(rule.good), 1).otherwise(0)


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def log_odds(votes: list[Column], rates: dict[str, float]) -> Column:
    """Log-odds of good, given the votes."""
    total = F.lit(_ln(rates["good"], 1 - rates["good"]))
    for j, v in enumerate(votes):
        bad, fine = rates[f"bad_{j}"], rates[f"good_{j}"]
        total = total + F.when(v == -1, _ln(fine, bad)).when(v == 1, _ln(1 - fine, 1 - bad)).otherwise(0.0)
    return total


def _ln(a: float, b: float) -> Column:
    return F.log(F.lit(a) / F.lit(b))


def estimate(features: DataFrame, rules: tuple[Rule, ...] = RULES, steps: int = STEPS) -> dict[str, float]:
    """EM over the vote patterns of documents that pass the base limits.

    The first guess of the class is what all-must-pass says: bad if any rule votes bad. With no documents the rates
    are the mean of their bounds.
    """
    names = [f"_v{j}" for j in range(len(rules))]
    votes = features.filter(~base_failed()).select(*[vote(r).alias(n) for r, n in zip(rules, names, strict=True)])
    patterns = votes.groupBy(*names).agg(F.count("*").alias("_n")).coalesce(1).checkpoint()
    columns = [F.col(n) for n in names]
    good = F.when(F.least(F.lit(1), *columns) < 0, 0.0).otherwise(1.0)
    rates: dict[str, float] = {}
    for _ in range(steps + 1):
        found = patterns.withColumn("_g", good).agg(*_rates(columns)).first().asDict()
        rates = {name: 0.5 if value is None else value for name, value in found.items()}
        good = F.lit(1.0) / (F.lit(1.0) + F.exp(-log_odds(columns, rates)))
    return rates


def _rates(votes: list[Column]) -> list[Column]:
    n, g = F.col("_n"), F.col("_g")

    def bounded(part: Column, whole: Column, name: str) -> Column:
        share = F.when(whole > 0, part / whole)
        return F.round(F.greatest(F.lit(FLOOR), F.least(F.lit(CEILING), share)), PLACES).alias(name)

    found = [bounded(F.sum(n * g), F.sum(n), "good")]
    for j, v in enumerate(votes):
        for name, weight in ((f"bad_{j}", n * (1 - g)), (f"good_{j}", n * g)):
            found.append(bounded(F.sum(F.when(v == -1, weight).otherwise(0.0)), F.sum(F.when(v != 0, weight).otherwise(0.0)), name))
    return found


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
    keep_text: bool = True,
    steps: int = STEPS,
) -> DataFrame:
    """`docs` with FEATURES, `base_failed`, the posterior `p_good` and `kept` (0.5 or more and not failed).

    Null text counts as empty, which fails the base limits; repeated rows are judged alike and each counts in the
    estimate; columns of the new names are replaced, others stay. The features are computed once: without `keep_text`
    the text goes and the numbers are checkpointed, with it both are stored as a table in the shared folder, which
    `release_scratch` deletes.
    """
    features = text_features(docs, text)
    if keep_text:
        path = scratch_path(ready(docs.sparkSession), "features")
        features.write.parquet(path)
        features = docs.sparkSession.read.schema(features.schema).parquet(path)
    else:
        features = features.drop(text).checkpoint()
    rates = estimate(features, rules, steps)
    p_good = F.lit(1.0) / (F.lit(1.0) + F.exp(-log_odds([vote(r) for r in rules], rates)))
    judged = features.withColumns({"base_failed": base_failed(), "p_good": p_good})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))


def oracle(rules: tuple[Rule, ...] = RULES, steps: int = STEPS) -> str:
    """The contract's columns for `documents` as DuckDB SQL; the EM steps are unrolled."""
    space, word = SPACE, WORD
    js = range(len(rules))
    votes = ", ".join(f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END AS v{j}" for j, r in enumerate(rules))
    odds = "ln(good / (1 - good))" + "".join(
        f" + CASE v{j} WHEN -1 THEN ln(good_{j} / bad_{j}) WHEN 1 THEN ln((1 - good_{j}) / (1 - bad_{j})) ELSE 0 END" for j in js
    )

    def bounded(part: str, whole: str, name: str) -> str:
        share = f"CASE WHEN {whole} > 0 THEN {part} / {whole} END"
        return f"coalesce(round(greatest({FLOOR}, least({CEILING}, {share})), {PLACES}), 0.5) AS {name}"

    rates = [bounded("sum(n * g)", "sum(n)", "good")]
    for j in js:
        for name, weight in ((f"bad_{j}", "n * (1 - g)"), (f"good_{j}", "n * g")):
            rates.append(bounded(f"sum(CASE WHEN v{j} = -1 THEN {weight} ELSE 0.0 END)", f"sum(CASE WHEN v{j} <> 0 THEN {weight} ELSE 0.0 END)", name))
    any_bad = " OR ".join(f"v{j} = -1" for j in js)
    chain = [f"m0 AS MATERIALIZED (SELECT {', '.join(rates)} FROM (SELECT *, CASE WHEN {any_bad} THEN 0.0 ELSE 1.0 END AS g FROM patterns))"]
    for k in range(steps):
        chain.append(f"m{k + 1} AS MATERIALIZED (SELECT {', '.join(rates)} FROM (SELECT patterns.*, 1 / (1 + exp(-({odds}))) AS g FROM patterns, m{k}))")
    return f"""
WITH t AS MATERIALIZED (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{word}') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{word}')) AS lines
    FROM documents),
f AS MATERIALIZED (
    SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[{space}]', '', 'g')) AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(regexp_extract_all(t, '\\p{{Lu}}')) AS n_upper,
        len(list_distinct(w)) AS n_distinct
    FROM t),
windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + {WINDOW - 1}], ' ') AS words
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM t)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, words) > 1),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(0, {WINDOW})) AS k FROM twice) GROUP BY doc_id),
d AS MATERIALIZED (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {votes}
    FROM (SELECT f.*, coalesce(r.n, 0) AS n_repeat_words FROM f LEFT JOIN r USING (doc_id))),
patterns AS MATERIALIZED (
    SELECT {', '.join(f'v{j}' for j in js)}, count(*) AS n FROM d WHERE NOT base_failed GROUP BY ALL),
{', '.join(chain)}
SELECT doc_id, {', '.join(f'{c}::BIGINT AS {c}' for c in BASE)}, base_failed,
    NOT base_failed AND 1 / (1 + exp(-({odds}))) >= 0.5 AS kept
FROM d, m{steps}
"""
