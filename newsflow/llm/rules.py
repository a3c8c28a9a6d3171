"""Quality rules under weak supervision: rules vote or abstain, EM weighs them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from newsflow.llm.common import by_text, id_type
from newsflow.llm.features import COUNTS, counts
from newsflow.session import materialise

#: Votes: -1 against the document, 1 for it, 0 abstains.
AGAINST, ABSTAIN, FOR = -1, 0, 1


def _ratio(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def _against(bad: Column) -> Column:
    return F.when(bad, AGAINST).otherwise(ABSTAIN)


def default_rules() -> dict[str, Column]:
    """Ten rules of two outcomes, so at most 2^10 = 1,024 patterns of votes exist in any corpus.

    Nine know one kind of defect each and abstain on texts free of it: that a
    text has no symbols says nothing about its other defects. Lengths of words
    and ends of lines say nothing of scripts written without blanks. The last speaks
    for texts that look plain in all respects at once.
    """
    many, lined = F.col("n_words") >= 50, F.col("n_lines") >= 3
    length, letters = _ratio("word_chars", "n_words"), _ratio("n_letters", "word_chars")
    ended, distinct = _ratio("n_ended", "n_lines"), _ratio("n_distinct", "n_words")
    symbols, spaced = _ratio("n_symbols", "n_words"), _ratio("n_unspaced", "word_chars") < 0.3
    return {
        "symbols": _against(symbols > 0.1),
        "capitals": _against(_ratio("n_upper", "n_letters") > 0.4),
        "repeated_words": _against(_ratio("n_repeat_words", "n_words") > 0.2),
        "repeated_lines": _against(lined & (_ratio("n_dup_lines", "n_lines") > 0.35)),
        "word_length": _against(spaced & ((length < 2.5) | (length > 12))),
        "letters": _against(many & (letters < 0.75)),
        "exclamations": _against(many & (_ratio("n_exclaims", "n_words") > 0.25)),
        "line_ends": _against(many & spaced & (ended < 0.2)),
        "distinct_words": _against(many & (distinct < 0.15)),
        "plain": F.when((letters > 0.8) & (ended > 0.5) & (symbols < 0.05) & (~many | (distinct > 0.3)), FOR).otherwise(ABSTAIN),
    }


def fit_votes(patterns: np.ndarray, weights: np.ndarray, prior: float = 0.5, rounds: int = 200) -> np.ndarray:
    """Expectation-maximisation over patterns of votes (rows) and how often each occurs.

    Returns each rule's accuracy: how often it is right when it votes. Whether
    it votes says nothing by itself. Accuracies start at 0.9, smoothed by
    twenty votes' worth of that, and stay within 0.55 and 0.99: a rule may be
    weak, but not misleading by design. The balance of the classes is given,
    not fitted, and even by default: a corpus that is mostly good must not
    outvote the only rule that knows a rare defect.
    """
    accuracy = np.full(patterns.shape[1], 0.9)
    for _ in range(rounds):
        good = posterior(patterns, prior, accuracy)
        right = weights @ ((patterns == FOR) * good[:, None] + (patterns == AGAINST) * (1 - good)[:, None])
        votes = weights @ (patterns != ABSTAIN)
        before = accuracy
        accuracy = np.clip((right + 18) / (votes + 20), 0.55, 0.99)
        if np.abs(accuracy - before).max(initial=0) < 1e-9:
            break
    return accuracy


def posterior(patterns: np.ndarray, prior: float, accuracy: np.ndarray) -> np.ndarray:
    """Probability that a document of each pattern is good."""
    return 1 / (1 + np.exp(-(np.log(prior / (1 - prior)) + patterns @ np.log(accuracy / (1 - accuracy)))))


def measured(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id`` and the counts of its whole text."""
    schema = f"id {id_type(df, id_col)}," + ",".join(f"{c} long" for c in COUNTS)
    return by_text(df, id_col, text_col, schema, lambda: lambda key, text: [(key, *counts(text))])


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, prior: float = 0.5, rules: dict[str, Column] | None = None) -> DataFrame:
    """Keep or drop documents by the probability of quality that the rules' votes give.

    Per row: id, the counts, base_failed (fewer than ten words, or more than a
    fifth of them repeated), the probability and kept. A document that fails
    the base is not kept; one on which no rule votes is. All documents vote in the fit: Spark counts the
    patterns of votes (1,024 at most by default) and only these counts
    reach the driver. Null and empty texts have no words, so they fail the
    base. Repeated rows and null ids give a row each; an empty table gives
    none; other columns are not read. Texts are read once; the counts are
    written out in between.
    """
    rules = rules or default_rules()
    names = list(rules)
    stored = materialise(measured(df, id_col, text_col).withColumn("_votes", F.array(*rules.values()).cast("array<int>")))
    seen = stored.groupBy("_votes").count().collect()
    patterns = np.array([r["_votes"] for r in seen], int).reshape(len(seen), len(names))
    accuracy = fit_votes(patterns, np.array([r["count"] for r in seen], float), prior)
    # The log odds are a sum over the rules; the fitted accuracies are constants of the plan.
    odds = F.lit(float(np.log(prior / (1 - prior))))
    for i, a in enumerate(accuracy, 1):
        odds = odds + F.element_at("_votes", i) * float(np.log(a / (1 - a)))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    probability = 1 / (1 + F.exp(-odds))
    return stored.select(
        F.col("id").alias(id_col),
        *COUNTS,
        failed.alias("base_failed"),
        probability.alias("quality"),
        (~failed & (probability >= threshold)).alias("kept"),
    )
