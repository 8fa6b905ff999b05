"""Quality rules: a decision list learned by sequential covering over text statistics.

``statistics`` counts words, symbols, repeated lines and repeated word windows of each whole text.
``learn`` grows rules (conjunctions of thresholds that mark bad texts) on one part of a bounded
labelled sample, prunes them on the other and keeps adding rules while they pay. ``verdict`` turns
the ordered rules into one Spark conditional expression.

Null texts count as empty: no words, nothing repeated. Every row is treated by itself, so repeated
rows and repeated ids give repeated results. An empty table gives none.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.llm.common import Words, flat, hashed_rank, pieces, runs, table, window_hashes
from zonalis.session import stage

SYMBOLS = b"#*$%&|<>"  # fixed values: the characters counted as symbols
WINDOW = 8
#: The learner sees at most this many labelled rows, the first in a fixed hash order.
LABELLED_BOUND = 20_000
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_distinct_words", "n_letters", "n_upper", "n_digits", "n_punctuation", "longest_word"]

_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
_LETTER = _UPPER.copy()
_LETTER[97:123] = 1
_LETTER[0xC3:0xF5] = 1  # lead bytes of non-ASCII characters, nearly all letters
_PUNCTUATION = np.zeros(256, np.int64)
_PUNCTUATION[list(b".,;:!?")] = 1
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(SYMBOLS)] = 1


def _distinct(values: np.ndarray) -> int:
    return len(np.unique(values))


def _repeated(hashes: np.ndarray) -> int:
    """Words inside a window of WINDOW words that occurs at least twice."""
    windows = window_hashes(hashes, WINDOW)
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    hit = np.zeros(len(windows), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    starts, ends = runs(hit)
    return int((ends - starts + WINDOW - 1).sum() - _overlap(starts, ends))


def _overlap(starts: np.ndarray, ends: np.ndarray) -> int:
    """Words counted by two neighbouring runs of windows."""
    return int(np.maximum(0, ends[:-1] + WINDOW - 1 - starts[1:]).sum())


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[bounds[1:]] - total[bounds[:-1]]


def count_texts(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Statistics of the texts data[bounds[i]:bounds[i+1]]."""
    words = Words(data, bounds, lower=False)
    hashes, first = words.hashes(), words.first
    lead = ((data & 0xC0) != 0x80).astype(np.int64)
    characters = np.concatenate([[0], np.cumsum(lead)])
    length = characters[words.ends] - characters[words.starts]
    breaks = np.concatenate([[-1], np.flatnonzero(data == 10)])
    out = {
        "n_words": np.diff(first),
        "word_chars": _per_row(length, first),
        "n_symbols": _per_row(_SYMBOL[data], bounds),
        "n_letters": _per_row(_LETTER[data], bounds),
        "n_upper": _per_row(_UPPER[data], bounds),
        "n_digits": _per_row(_DIGIT[data], bounds),
        "n_punctuation": _per_row(_PUNCTUATION[data], bounds),
    }
    # a line of a row is known by the last line break before its words; rows are split apart below
    line = np.searchsorted(breaks, words.starts, "right")
    rest = {k: np.zeros(len(bounds) - 1, np.int64) for k in
            ("n_repeat_words", "n_dup_lines", "n_lines", "n_distinct_words", "longest_word")}
    for i in np.flatnonzero(np.diff(first)):
        a, b = first[i], first[i + 1]
        rest["n_repeat_words"][i] = _repeated(hashes[a:b])
        rest["n_distinct_words"][i] = _distinct(hashes[a:b])
        rest["longest_word"][i] = length[a:b].max()
        held = _distinct(line[a:b])
        rest["n_lines"][i] = held
        if held > 1:
            text = data[bounds[i] : bounds[i + 1]].tobytes()
            lines = [x for x in text.split(b"\n") if x.split()]
            rest["n_dup_lines"][i] = len(lines) - len(set(lines))
    return out | rest


def statistics(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and the counts of each row's whole text, as longs."""
    kind = df.schema[key].dataType.simpleString()
    names = COUNTS + MORE

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = flat(batch.column("text"))
            for start, stop in pieces(bounds):
                part = bounds[start : stop + 1]
                found = count_texts(data[part[0] : part[-1]], part - part[0])
                columns = [batch.column("key").slice(start, stop - start)]
                columns += [pa.array(found[n].astype(np.int64)) for n in names]
                yield pa.RecordBatch.from_arrays(columns, ["key", *names])

    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    shape = f"key {kind}, " + ", ".join(f"{n} bigint" for n in names)
    return rows.mapInArrow(count, shape).withColumnRenamed("key", key)


def features() -> dict[str, Column]:
    """What rules may ask for: shares and sizes, null where a text has no words."""
    words = F.nullif(F.col("n_words"), F.lit(0))
    share = lambda a, b: F.col(a) / F.nullif(F.col(b), F.lit(0))
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word": F.col("word_chars") / words,
        "longest_word": F.col("longest_word").cast("double"),
        "symbols_per_word": F.col("n_symbols") / words,
        "punctuation_per_word": F.col("n_punctuation") / words,
        "upper_share": share("n_upper", "n_letters"),
        "digit_share": share("n_digits", "word_chars"),
        "repeat_share": F.col("n_repeat_words") / words,
        "distinct_share": F.col("n_distinct_words") / words,
        "dup_line_share": share("n_dup_lines", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        v = values[self.feature]
        return v >= self.threshold if self.above else v <= self.threshold

    def column(self) -> Column:
        c = features()[self.feature]
        return F.coalesce(c >= self.threshold if self.above else c <= self.threshold, F.lit(False))


Rule = tuple[Condition, ...]


def covers(rule: Rule, values: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(values.values()))), bool)
    for c in rule:
        out &= c.holds(values)
    return out


def _gain(p: np.ndarray, n: np.ndarray, p0: int, n0: int) -> np.ndarray:
    """Information gained on the bad rows that stay covered."""
    with np.errstate(divide="ignore", invalid="ignore"):
        value = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
    return np.where(p > 0, value, -np.inf)


def _best(values: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, Condition | None]:
    """The threshold of any feature with the highest gain; ties go to the first feature."""
    p0, n0 = int(bad.sum()), int((~bad).sum())
    best: tuple[float, Condition | None] = (1e-9, None)
    for name, v in values.items():
        known = np.flatnonzero(~np.isnan(v))
        order = known[np.argsort(v[known], kind="stable")]
        ranked = v[order]
        edge = np.flatnonzero(ranked[1:] > ranked[:-1])
        if not len(edge):
            continue
        p, n = np.cumsum(bad[order]), np.cumsum(~bad[order])
        for above in (False, True):
            pp = p[-1] - p[edge] if above else p[edge]
            nn = n[-1] - n[edge] if above else n[edge]
            gains = _gain(pp, nn, p0, n0)
            k = int(np.argmax(gains))
            if gains[k] > best[0]:
                middle = float((ranked[edge[k]] + ranked[edge[k] + 1]) / 2)
                best = (float(gains[k]), Condition(name, above, middle))
    return best


def grow(values: dict[str, np.ndarray], bad: np.ndarray, longest: int = 4) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < longest and (~bad[inside]).any():
        _, condition = _best({k: v[inside] for k, v in values.items()}, bad[inside])
        if condition is None:
            break
        rule += (condition,)
        inside &= condition.holds(values)
    return rule


def prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float, int]:
    """The beginning of the rule with the best (p - n) / (p + n); its precision and cover."""
    best: tuple[float, Rule, float, int] = (-np.inf, (), 0.0, 0)
    for k in range(1, len(rule) + 1):
        hit = covers(rule[:k], values)
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        worth = (p - n) / (p + n) if p + n else -np.inf
        if worth > best[0]:
            best = (worth, rule[:k], p / (p + n), p)
    return best[1], best[2], best[3]


def learn(values: dict[str, np.ndarray], bad: np.ndarray, rank: np.ndarray, precision: float = 0.95,
          support: int = 5, most: int = 24) -> list[Rule]:
    """Ordered rules for bad rows. ``rank`` deals rows to the growing and the pruning part.

    A rule is kept when, after pruning, it covers at least ``support`` bad rows with at least
    ``precision`` on the pruning part; the first that fails ends the list. No labels, or only one
    class, give no rules.
    """
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    third = (rank % 3) == 0
    while len(rules) < most:
        a, b = left & ~third, left & third
        if not bad[a].any() or not bad[b].any() or bad[a].all():
            break
        pick = lambda m: ({k: v[m] for k, v in values.items()}, bad[m])
        rule, right, cover = prune(grow(*pick(a)), *pick(b))
        if not rule or right < precision or cover < support:
            break
        rules.append(rule)
        left &= ~covers(rule, values)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, 0 where none does."""
    chain = None
    for i, rule in enumerate(rules, 1):
        holds = rule[0].column()
        for c in rule[1:]:
            holds = holds & c.column()
        chain = F.when(holds, F.lit(i)) if chain is None else chain.when(holds, F.lit(i))
    return F.lit(0) if chain is None else chain.otherwise(F.lit(0))


def fit(counts: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality",
        bound: int = LABELLED_BOUND, **options) -> list[Rule]:
    """Rules from a labelled sample of at most ``bound`` ids; null labels and keys are left out.

    Of an id's rows the one with the least statistics counts, with the least of the id's labels.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.min(label).alias(label))
    sample = known.orderBy(hashed_rank(key), key).limit(bound)
    asked = features()
    # one row per id, however often it is repeated: at most ``bound`` rows
    joined = counts.join(F.broadcast(sample), key).groupBy(key).agg(
        F.min(label).alias("label"), F.min(F.struct(*[c.alias(n) for n, c in asked.items()])).alias("least"))
    rows = joined.select(F.col(key).alias("key"), "label", "least.*").toPandas().sort_values("key")
    values = {n: rows[n].to_numpy(float, na_value=np.nan) for n in asked}
    return learn(values, rows["label"].to_numpy() == 0, np.arange(len(rows)), **options)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    """The counts with ``base_failed``, the number of the rule that rejects, and ``kept``."""
    return (
        counts.withColumn("base_failed", base_failed())
        .withColumn("rule", verdict(rules))
        .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
    )


def op10_quality(spark, sf_dir):
    """Statistics and verdict of every document."""
    counts = stage(statistics(table(spark, sf_dir, "documents")), "statistics")
    rules = fit(counts, table(spark, sf_dir, "labels"))
    return judge(counts, rules).select("doc_id", *COUNTS, "base_failed", "kept", "rule")
