"""Quality rules: a decision list learned by sequential covering, run as Spark conditions.

Each document's statistics are counted once.  From a bounded, documented sample of labelled rows
(``SAMPLE`` rows, those whose id hashes lowest) rules are learned one after another: a conjunction
of thresholds grows on one part of the sample by the gain in information, its last conditions are
pruned by their worth on the other part, and it joins the list if it is precise there.  Rows that
a rule covers are taken out before the next one grows; those of a rule that isn't precise, or covers
so few that chance may do it, are only set aside, and learning goes on with the rest.  The list becomes one ordered Spark
condition: the first rule that holds rejects the document, else it is kept.

Documents that fail the base test (too short, or mostly repeated) are rejected whatever the list
says.  Null or empty text: no words, so it fails the base test.  No labels, or labels of one
class: an empty list.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltrail.llm import words

SAMPLE = 20_000  # labelled rows that the list is learned from
CUTS = 32  # thresholds tried for a statistic: so many quantiles
PRECISE = 0.95  # least share of low-quality rows among those a rule covers, on the pruning part
SUPPORT = 0.002  # least share of the low-quality rows there that a rule covers
LEAST = 2  # and so many of them
CHANCE = 0.01  # that a rule of all those tried covers as many by luck
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_digits", "n_bars", "n_distinct")
SYMBOLS = b"#*$%&|<>"


def flags(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


SYMBOL, DIGIT, BAR = flags(SYMBOLS), flags(b"0123456789"), flags(b"|")


def duplicates(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether a key stands there at least twice, whether it stood earlier)."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice, later = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    later[order[1:][same]] = True
    return twice, later


def count(texts: list[bytes]) -> dict[str, np.ndarray]:
    w = words.split(texts)
    word = w.hashes()
    owner = words.mix(w.text_of.astype(np.uint64) + np.uint64(1))
    windows = w.windows(3)
    at = np.arange(len(word) + 1)
    keys = words.run_hash(word, at[windows], at[windows] + 3) ^ owner[windows] if len(windows) else np.empty(0, dtype=np.uint64)
    twice, _ = duplicates(keys)
    repeated = np.zeros(len(word), dtype=bool)
    for i in range(3):
        repeated[windows[twice] + i] = True
    lines = [[x for x in t.split(b"\n") if x.strip()] if b"\n" in t else [t] if t.strip() else [] for t in texts]
    _, seen = duplicates(word ^ owner)
    dark = ~words.SPACE[w.data] & ((w.data & 0xC0) != 0x80)
    n_words = np.diff(w.first)
    return {
        "n_words": n_words, "word_chars": w.per_text(dark), "n_symbols": w.per_text(SYMBOL[w.data]),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], dtype=np.int64), "n_repeat_words": w.per_text_words(repeated),
        "n_lines": np.array([len(x) for x in lines], dtype=np.int64), "n_digits": w.per_text(DIGIT[w.data]), "n_bars": w.per_text(BAR[w.data]),
        "n_distinct": w.per_text_words(~seen),
    }


def statistics(text: Column) -> Column:
    """struct of ``COUNTS`` of each whole text."""

    @F.arrow_udf("struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">")
    def stats(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            found = [count(texts) for _, texts in words.parts([pa.RecordBatch.from_arrays([column], ["t"])], "t")]
            yield pa.StructArray.from_arrays([pa.array(np.concatenate([f[c] for f in found]) if found else np.empty(0), pa.int64()) for c in COUNTS], list(COUNTS))

    return stats(text)


#: What rules put thresholds on: name -> value from the counts (a divisor of 0 gives 0).
FEATURES = {
    "n_words": ("n_words", None), "word_length": ("word_chars", "n_words"), "symbols_per_word": ("n_symbols", "n_words"), "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"), "digits_per_char": ("n_digits", "word_chars"), "bars_per_word": ("n_bars", "n_words"), "distinct_share": ("n_distinct", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}


def feature(stats: Column, name: str) -> Column:
    a, b = FEATURES[name]
    value = stats[a].cast("double")
    return value if b is None else F.when(stats[b] > 0, value / stats[b]).otherwise(0.0)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value > threshold, else value <= threshold
    threshold: float

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        return rows[self.feature] > self.threshold if self.above else rows[self.feature] <= self.threshold

    def column(self, stats: Column) -> Column:
        value = feature(stats, self.feature)
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def covers(rule: Rule, rows: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, dtype=bool)
    for c in rule:
        out &= c.holds(rows)
    return out


def grow(rows: dict[str, np.ndarray], bad: np.ndarray, live: np.ndarray) -> Rule:
    """Conditions of the best gain (FOIL's), until no good row is covered or nothing gains."""
    rule: list[Condition] = []
    inside = live.copy()
    while (inside & ~bad).any() and len(rule) < 6:
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        best, pick = 0.0, None
        for name in FEATURES:
            values = rows[name]
            there = np.unique(values[inside])
            for i in np.unique(np.searchsorted(there, np.quantile(values[inside], np.linspace(0, 1, CUTS + 1)), side="right"))[:-1]:
                cut = (there[i - 1] + there[i]) / 2  # midway to the next value
                over = inside & (values > cut)
                for above, held in ((True, over), (False, inside & ~over)):
                    p = (held & bad).sum()
                    if p:
                        gain = p * (np.log2(p / held.sum()) - np.log2(p0 / (p0 + n0)))
                        if gain > best + 1e-9:
                            best, pick = gain, (Condition(name, above, float(cut)), held)
        if pick is None:
            break
        rule.append(pick[0])
        inside = pick[1]
    return tuple(rule)


def learn(rows: dict[str, np.ndarray], bad: np.ndarray, prune_part: np.ndarray) -> list[Rule]:
    """The ordered rules that cover low-quality rows (``bad``)."""
    rules: list[Rule] = []
    live = np.ones(len(bad), dtype=bool)
    aside = np.zeros(len(bad), dtype=bool)  # rows of rules that failed
    least = max(LEAST, SUPPORT * (bad & prune_part).sum())
    tried = 0
    while (live & ~aside & bad & ~prune_part).any():
        rule = grow(rows, bad, live & ~aside & ~prune_part)
        checked = live & prune_part

        def worth(r: Rule, checked: np.ndarray = checked) -> float:
            held = covers(r, rows, len(bad)) & checked
            return ((held & bad).sum() - (held & ~bad).sum()) / max(1, held.sum())

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        held = covers(rule, rows, len(bad))
        p, n, tried = (held & checked & bad).sum(), (held & checked).sum(), tried + 1
        if not rule:
            break
        if p < least or p < PRECISE * n or ((checked & bad).sum() / max(1, checked.sum())) ** p > CHANCE / tried:
            aside |= held
            continue
        rules.append(rule)
        live &= ~held
    return rules


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Order (a hash of id and text), features, label and part of at most ``sample`` labelled documents; of several labels of one id the lowest counts."""
    ids = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most ``sample`` ids
    rows = rows.select("doc_id", "quality", F.xxhash64("doc_id", "text").alias("at"), statistics(F.col("text")).alias("stats"))
    return rows.select("at", *(feature(F.col("stats"), f).alias(f) for f in FEATURES), (F.col("quality") == 0).alias("bad"), (F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)) == 0).alias("prune"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    # An id may stand in several rows: the limit holds for the rows as well, and takes any of them alike.
    t = labelled(docs, labels, sample).orderBy("at", *FEATURES, "bad", "prune").limit(sample).toPandas()
    if t["bad"].nunique() < 2:
        return []
    return learn({f: t[f].to_numpy(dtype=float) for f in FEATURES}, t["bad"].to_numpy(dtype=bool), t["prune"].to_numpy(dtype=bool))


def verdict(stats: Column, rules: list[Rule]) -> Column:
    """True unless a rule of the ordered list holds."""
    out = F
    for rule in rules:
        test = rule[0].column(stats)
        for c in rule[1:]:
            test = test & c.column(stats)
        out = out.when(test, F.lit(False))
    return F.lit(True) if out is F else out.otherwise(F.lit(True))


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document."""
    rows = docs.select("doc_id", statistics(F.col("text")).alias("stats"))
    s = F.col("stats")
    return rows.select("doc_id", *(s[c].alias(c) for c in COUNTS), base_failed(s).alias("base_failed"), (~base_failed(s) & verdict(s, rules)).alias("kept"))


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.select("row", statistics(F.col("row.text")).alias("stats"))
    s = F.col("stats")
    return rows.where(~base_failed(s) & verdict(s, rules)).select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))
