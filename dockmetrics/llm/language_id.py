"""Hierarchical language identification with linear support vector machines.

Features: hashed byte 1- to 4-grams of the lower-cased text, square-rooted counts of
unit length, over the whole text. First the language family is predicted (one
machine per family against the rest), then one-versus-one machines separate the languages
of that family by votes.

Fitting uses every labelled row. A hash of the id and text deals the rows over shards of
about ``per_language`` rows of the most frequent language; of a rarer one each shard holds a
share, at least ``LEAST_ROWS`` (or all), so that its rows come again in several shards.
Executors fit the machines of each shard, and a machine of the model is the mean of its
machines of all shards. Sums are kept in fixed point: they do not depend on how the rows
are split. What reaches the driver are sums per machine, however many rows there are.
Prediction sees nothing but the text. The score is the family's share of confidence times
the language's, between 0 and 1.

The score says which learned language is nearest, not whether any is near. For that
``with_floors`` learns how alike to their language's mean vector labelled texts of each length are
(by powers of two, from the beginnings of all labelled texts); a text below the floor of
its length is in none of them. That holds for any number of languages and families.

Rows whose text is null or has no letter get ``und`` with score 0, as do all rows if
nothing was learned. Rows that repeat are each judged, and learned from once. Languages outside ``FAMILIES`` form a family of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import cached_property
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockmetrics.llm.common import release_memory, whole_text

UNKNOWN = "und"
DIMS = 4096
PER_LANGUAGE = 300
LEAST_ROWS = 50
#: Steps of the fixed-point sums in one.
SCALE = 1 << 34
#: Families of related languages by ISO 639-1 code.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
}


def has_letter(text: str) -> bool:
    """Whether a text has a character of Unicode's letter categories; numbers of any kind,
    such as a half or a Roman four, are none."""
    return any(map(str.isalpha, text))


def _lowered(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def _grams(lowered: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """For each length of grams their places among the dimensions, in the text's order."""
    gram = raw = np.frombuffer(lowered, np.uint8).astype(np.uint32)
    for n in range(1, 5):
        if n > 1:
            gram = gram[:-1] * np.uint32(257) + raw[n - 1 :]
        if not len(gram):
            break
        yield n, (gram * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(20)


def features(text: str) -> np.ndarray:
    """The unit feature vector of a whole text."""
    counts = np.zeros(DIMS, np.float64)
    for _, places in _grams(_lowered(text)):
        counts += np.bincount(places, minlength=DIMS)
    vector = np.sqrt(counts)
    norm = np.sqrt((vector * vector).sum())
    return (vector / norm if norm else vector).astype(np.float32)


def fit_svm(x: np.ndarray, positive: np.ndarray, steps: int = 150, c: float = 20.0) -> np.ndarray:
    """Weights (bias last) of a linear machine with squared hinge loss; both classes weigh
    the same. Accelerated gradient descent, on the rows' coefficients if there are fewer
    rows than dimensions: the weights of every step are a sum of rows."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    weight = np.where(positive, 0.5 / max(positive.sum(), 1), 0.5 / max((~positive).sum(), 1)).astype(np.float32)
    rate = 1.0 / (1.0 / c + 2 * 2.0)  # rows have length sqrt(2) at most
    few = len(x) < x.shape[1]
    products = x @ x.T if few else x
    w = look = np.zeros(products.shape[1], np.float32)
    for k in range(steps):
        slack = np.maximum(0, 1 - y * (products @ look))
        pull = weight * slack * y
        step = look - rate * (look / c - 2 * (pull if few else pull @ x))
        look = step + k / (k + 3) * (step - w)
        w = step
    return w @ x if few else w


def family_of(lang: str) -> str:
    return next((name for name, codes in FAMILIES.items() if lang in codes), f"={lang}")


def families_of(langs: list[str]) -> dict[str, list[str]]:
    """The languages of each family, both in ascending order."""
    names = {lang: family_of(lang) for lang in sorted(set(langs))}
    return {name: [lang for lang in names if names[lang] == name] for name in sorted(set(names.values()))}


@dataclass
class LanguageModel:
    families: list[list[str]]
    family_weights: np.ndarray  # one column per family
    pairs: dict[tuple[str, str], np.ndarray]
    #: Unit mean vector of each language.
    means: dict[str, np.ndarray] = field(default_factory=dict)
    #: Least likeness by ``length_class``.
    floors: dict[int, float] = field(default_factory=dict)

    @classmethod
    def fit(cls, x: np.ndarray, langs: list[str]) -> LanguageModel:
        labels = np.array(langs, dtype=object)
        families = list(families_of(langs).values())
        weights = [fit_svm(x, np.isin(labels, members)) for members in families] if len(families) > 1 else []
        pairs = {}
        for members in families:
            for a, b in combinations(members, 2):
                rows = (labels == a) | (labels == b)
                pairs[a, b] = fit_svm(x[rows], labels[rows] == a)
        columns = np.array(weights, np.float32).T if weights else np.zeros((x.shape[1] + 1, 0), np.float32)
        means = {lang: x[labels == lang].mean(axis=0) for lang in sorted(set(langs))}
        return cls(families, columns, pairs, {lang: m / max(np.linalg.norm(m), 1e-9) for lang, m in means.items()})

    @cached_property
    def mean_rows(self) -> np.ndarray:
        """The means, a row per dimension."""
        return np.stack(list(self.means.values()), axis=1)

    def likeness(self, x: np.ndarray) -> np.ndarray:
        """The cosine to the nearest language's mean."""
        return (x @ np.stack(list(self.means.values())).T).max(axis=1)

    def start_likenesses(self, starts: list[str]) -> list[float]:
        """The likeness of beginnings of one text, each the start of the next. Every gram is
        taken once, for the first beginning that holds it."""
        lowered = [_lowered(t) for t in starts]
        if not all(map(lowered[-1].startswith, lowered)):  # a letter's lower case can depend on the next one
            return self.likeness(np.stack([features(t) for t in starts])).tolist()
        grams, means = list(_grams(lowered[-1])), self.mean_rows
        counts, begin, total, found = np.zeros(DIMS, np.int64), 0, 0, []
        for end in map(len, lowered):
            new = np.concatenate([places[max(begin - n + 1, 0) : max(end - n + 1, 0)] for n, places in grams])
            np.add.at(counts, new, 1)
            begin, total = end, total + len(new)
            found.append(float((np.sqrt(counts.astype(np.float32)) @ means).max() / np.sqrt(total)))
        return found

    def typical(self, texts: list[str], x: np.ndarray) -> np.ndarray:
        """Whether texts are as alike to a learned language as labelled ones of their length."""
        if not self.floors:
            return np.ones(len(texts), bool)
        top = max(self.floors)
        floors = np.array([self.floors.get(min(length_class(t), top), -1.0) for t in texts])
        return self.likeness(x) >= floors

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.families:
            return [UNKNOWN] * len(x), np.zeros(len(x))
        x = np.hstack([x, np.ones((len(x), 1), np.float32)])
        if len(self.families) > 1:
            confidence = _sigmoid(4 * (x @ self.family_weights))
            family = confidence.argmax(axis=1)
            score = confidence[np.arange(len(x)), family]
        else:
            family, score = np.zeros(len(x), int), np.ones(len(x))
        found = np.empty(len(x), dtype=object)
        for number, members in enumerate(self.families):
            rows = np.flatnonzero(family == number)
            votes = np.zeros((len(rows), len(members)))
            for (i, a), (j, b) in combinations(enumerate(members), 2):
                wins = _sigmoid(4 * (x[rows] @ self.pairs[a, b]))
                votes[:, i] += wins
                votes[:, j] += 1 - wins
            if len(rows):
                found[rows] = np.array(members, dtype=object)[votes.argmax(axis=1)]
                score[rows] *= votes.max(axis=1) / max(len(members) - 1, 1) if len(members) > 1 else 1.0
        return found.tolist(), np.clip(score, 0.0, 1.0)


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def length_class(text: str) -> int:
    return len(text).bit_length()


def _labelled(docs: DataFrame, text_col: str, lang_col: str, id_col: str) -> DataFrame:
    """(lang, text, a, b) of the rows to learn from; the two hashes tell which rows repeat."""
    row = [F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), whole_text(text_col)) for seed in (1, 2)]
    known = docs.filter(F.col(lang_col).isNotNull() & (F.col(lang_col) != UNKNOWN))
    return known.select(F.col(lang_col).alias("lang"), whole_text(text_col).alias("text"), row[0].alias("a"), row[1].alias("b"))


def _row_counts(labelled: DataFrame) -> dict[str, int]:
    """How many rows a language has; those that repeat count once."""
    counts = labelled.groupBy("lang").agg(F.count_distinct("a", "b").alias("n"))
    return {r["lang"]: r["n"] for r in counts.collect()}


def _by_language(values: dict[str, int]) -> Column:
    chosen = F.lit(1)
    for lang, value in values.items():
        chosen = F.when(F.col("lang") == lang, value).otherwise(chosen)
    return chosen


def _sample(docs: DataFrame, text_col: str, lang_col: str, id_col: str, per_language: int) -> DataFrame | None:
    """(lang, text) of at most about ``per_language`` rows of each language, for a look at what
    there is to learn from; None without any label. Nothing is learned from it alone."""
    labelled = _labelled(docs, text_col, lang_col, id_col)
    counts = _row_counts(labelled)
    if not counts:
        return None
    parts = {lang: -(-n // per_language) for lang, n in counts.items()}
    chosen = labelled.filter(F.pmod("a", _by_language(parts)) == 0)
    return chosen.dropDuplicates(["lang", "a", "b"]).select("lang", "text")


def _shard_machines(labelled: DataFrame, counts: dict[str, int], per_language: int) -> DataFrame:
    """(kind, a, b, at, total, shards): the weights of each machine in fixed point, summed over the
    shards that have it, and the summed vectors of each language."""
    shards = max(-(-n // per_language) for n in counts.values())
    parts = {lang: min(shards, max(1, n // LEAST_ROWS)) for lang, n in counts.items()}
    by = _by_language(parts)
    places = F.sequence(F.pmod("a", by).cast("int"), F.lit(shards - 1), by)
    # Repeated rows have one hash, so they meet in their shard.
    dealt = labelled.withColumn("shard", F.explode(places)).repartition("shard").dropDuplicates(["shard", "lang", "a", "b"])

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        learned = sorted((lang, features(t).tobytes()) for lang, t in zip(rows["lang"], rows["text"]) if has_letter(t))
        found: list[tuple[str, str, str, np.ndarray]] = []
        if learned:
            langs = [lang for lang, _ in learned]
            x = np.stack([np.frombuffer(v, np.float32) for _, v in learned])
            model = LanguageModel.fit(x, langs)
            found += [("family", family_of(m[0]), "", w) for m, w in zip(model.families, model.family_weights.T)]
            found += [("pair", a, b, w) for (a, b), w in model.pairs.items()]
            labels = np.array(langs, dtype=object)
            first = [lang for lang in model.means if rows["shard"].iat[0] < parts[lang]]
            found += [("sum", lang, "", x[labels == lang].sum(axis=0, dtype=np.float64)) for lang in first]
        tables = [
            pd.DataFrame({"kind": kind, "a": a, "b": b, "at": np.arange(len(v), dtype=np.int32), "value": np.rint(v.astype(np.float64) * SCALE).astype(np.int64)})
            for kind, a, b, v in found
        ]
        release_memory()
        return pd.concat(tables) if tables else pd.DataFrame({"kind": [], "a": [], "b": [], "at": [], "value": []})

    machines = dealt.groupBy("shard").applyInPandas(fit, "kind string, a string, b string, at int, value long")
    return machines.groupBy("kind", "a", "b", "at").agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("shards"))


def fit_language_model(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    per_language: int = PER_LANGUAGE,
) -> LanguageModel:
    """Learns from all rows of ``docs`` with a language and a letter."""
    nothing = LanguageModel([], np.zeros((DIMS + 1, 0), np.float32), {})
    labelled = _labelled(docs, text_col, lang_col, id_col)
    counts = _row_counts(labelled)
    if not counts:
        return nothing
    sums = _shard_machines(labelled, counts, per_language).toPandas().sort_values("at")
    of = {key: rows["total"].to_numpy(np.float64) / SCALE / rows["shards"].to_numpy() for key, rows in sums.groupby(["kind", "a", "b"])}
    means = {lang: vector for (kind, lang, _), vector in of.items() if kind == "sum"}
    if not means:
        return nothing
    families = families_of(list(means))
    none = np.zeros(DIMS + 1)  # languages that never met in a shard
    weights = [of.get(("family", name, ""), none) for name in families] if len(families) > 1 else []
    columns = np.array(weights, np.float32).T if weights else np.zeros((DIMS + 1, 0), np.float32)
    pairs = {
        (a, b): of.get(("pair", a, b), none).astype(np.float32) for members in families.values() for a, b in combinations(members, 2)
    }
    units = {lang: (m / max(np.linalg.norm(m), 1e-9)).astype(np.float32) for lang, m in sorted(means.items())}
    return LanguageModel(list(families.values()), columns, pairs, units)


def with_floors(
    model: LanguageModel,
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    per_language: int = PER_LANGUAGE,
) -> LanguageModel:
    """The model with floors from all the rows that it learned from. A floor lies as far below the
    lowest hundredth of its length's labelled texts as that lies below their median. Of languages
    with more than ``per_language`` rows each weighs the same, so that a frequent one does not set
    the floors of others. Likeness counts in whole steps of 1e-5, and a floor is a step lower."""
    labelled = _labelled(docs, text_col, lang_col, id_col)
    counts = _row_counts(labelled)
    if not counts or not model.families:
        return model

    @F.pandas_udf("array<double>")
    def likenesses(texts: pd.Series) -> pd.Series:
        """By class, from one on, that of the shortest beginning; -1 without a letter."""
        found = []
        for text in texts:
            starts = [text[: 1 << k] for k in range(length_class(text))]
            likes = model.start_likenesses(starts) if starts else []
            found.append([like if has_letter(t) else -1.0 for like, t in zip(likes, starts)])
        release_memory()
        return pd.Series(found, dtype=object)

    rows = labelled.select("lang", "a", "b", likenesses("text").alias("likes")).dropDuplicates(["lang", "a", "b"])
    every = rows.select("lang", F.posexplode("likes").alias("at", "like")).filter("like >= 0")
    same = every.groupBy("lang", "at", (F.floor(F.col("like") * 1e5) / 1e5).alias("like")).agg(F.count(F.lit(1)).alias("n"))
    share = {lang: max(1.0, n / per_language) for lang, n in counts.items()}
    weight = F.col("n") * _by_language({lang: round(max(share.values()) / s) for lang, s in share.items()})
    lowest, middle = (F.percentile("like", F.lit(p), weight) for p in (0.01, 0.5))
    by_class = same.groupBy("at").agg(middle.alias("half"), lowest.alias("low"))
    return replace(model, floors={r["at"] + 1: 2 * r["low"] - r["half"] - 1e-5 for r in by_class.collect()})


def language_column(model: LanguageModel, text_col: str = "text") -> Column:
    """A struct of ``lang_pred`` and ``score`` of a text column; if the model has floors, also
    ``typical`` (not under them)."""
    names = ["lang_pred", "score", *(["typical"] if model.floors else [])]

    @F.pandas_udf("lang_pred string, score double" + (", typical boolean" if model.floors else ""))
    def predicted(texts: pd.Series) -> pd.DataFrame:
        langs, scores, typical = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        written = [i for i, t in enumerate(texts) if t is not None and has_letter(t)]
        for begin in range(0, len(written), 512):
            some = written[begin : begin + 512]
            x = np.stack([features(texts.iat[i]) for i in some])
            found, score = model.predict(x)
            scores[some] = score
            typical[some] = model.typical([texts.iat[i] for i in some], x)
            for i, lang in zip(some, found):
                langs[i] = lang
        release_memory()
        return pd.DataFrame({"lang_pred": langs, "score": scores, "typical": typical})[names]

    return predicted(F.col(text_col).cast("string"))


def held_out(id_col: str = "doc_id") -> Column:
    """True for the quarter of rows that are never learned from."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
