"""Language of whole texts in two steps: the family, then the language within it.

Features are hashed character n-grams of letters. A linear support vector machine per
family (against the rest) chooses the family; within it, one machine per pair of
languages votes. The machines learn from a bounded sample of labelled rows, at most
``SAMPLE`` expected in all, shared evenly by the languages; everything else covers all rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.llm.chargrams import code_points, counted, hashed, letters, unit_rows
from airq.llm.tables import held_out
from airq.llm.words import slices

DIMS, SAMPLE = 2048, 4000
LETTER = re.compile(r"[^\W\d_]")
OUT = "doc_id long, held_out boolean, lang_pred string, score double"

#: Families of common language codes; any other code is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}


def features(texts: list[str]) -> np.ndarray:
    """Unit rows of square roots of letter n-gram counts (one and three letters); white space, digits and marks count as one separator."""
    alpha, parts = letters(), []
    for t in texts:
        p = code_points(t.lower())
        p = np.where(alpha[p], p, np.uint32(32))
        p = p[np.flatnonzero(np.concatenate([[True], (p[1:] != 32) | (p[:-1] != 32)]))] if len(p) else p
        parts.append(np.concatenate([hashed(p, 1, DIMS), hashed(p, 3, DIMS)]))
    return unit_rows(np.sqrt(counted(parts, DIMS)))


def machine(x: np.ndarray, y: np.ndarray, cost: float = 4.0, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Weights (bias last) of a linear support vector machine with squared hinge loss, by dual coordinate descent; ``y`` is 1 or -1."""
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1).astype(np.float64)
    w, a = np.zeros(x.shape[1]), np.zeros(len(x))
    curve = (x * x).sum(axis=1) + 0.5 / cost
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            step = max(a[i] - (y[i] * (x[i] @ w) - 1 + 0.5 * a[i] / cost) / curve[i], 0.0) - a[i]
            if step:
                a[i] += step
                w += step * y[i] * x[i]
    return w.astype(np.float32)


@dataclass
class LanguageModel:
    families: list[str] = field(default_factory=list)
    members: dict[str, list[str]] = field(default_factory=dict)
    family_weights: np.ndarray | None = None
    pair_weights: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Languages and scores: the chances that family and language hold, by a logistic of their margins, multiplied."""
        n = len(x)
        if not self.families:
            return ["und"] * n, np.zeros(n)
        margins = x @ self.family_weights[:, :-1].T + self.family_weights[:, -1]
        chosen = margins.argmax(axis=1)
        if len(self.families) > 1:
            rest = np.partition(margins, -2, axis=1)[:, -2]
            score = 1 / (1 + np.exp(-(margins.max(axis=1) - rest)))
        else:
            score = np.ones(n)
        lang = np.empty(n, dtype=object)
        for f, name in enumerate(self.families):
            own = np.flatnonzero(chosen == f)
            langs = self.members[name]
            lang[own] = langs[0]
            if len(langs) == 1 or not len(own):
                continue
            votes, margin = np.zeros((len(own), len(langs))), np.zeros((len(own), len(langs)))
            for (a, b), w in self.pair_weights.items():
                if a in langs and b in langs:
                    m = x[own] @ w[:-1] + w[-1]
                    ia, ib = langs.index(a), langs.index(b)
                    votes[:, ia] += m >= 0
                    votes[:, ib] += m < 0
                    margin[:, ia] += m
                    margin[:, ib] -= m
            best = (votes + 1e-3 * np.tanh(margin)).argmax(axis=1)
            lang[own] = np.array(langs, dtype=object)[best]
            score[own] *= 1 / (1 + np.exp(-2 * margin[np.arange(len(own)), best] / (len(langs) - 1)))
        return lang.tolist(), np.clip(score, 0, 1)


def fit(x: np.ndarray, langs: list[str]) -> LanguageModel:
    model, lang = LanguageModel(), np.array(langs, dtype=object)
    for code in sorted(set(langs)):
        model.members.setdefault(FAMILY.get(code, code), []).append(code)
    model.families = sorted(model.members)
    if model.families:
        fam = np.array([FAMILY.get(code, code) for code in langs], dtype=object)
        model.family_weights = np.stack([machine(x, np.where(fam == f, 1.0, -1.0)) for f in model.families])
    for own in model.members.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                pick = (lang == a) | (lang == b)
                model.pair_weights[a, b] = machine(x[pick], np.where(lang[pick] == a, 1.0, -1.0))
    return model


def sample(docs: DataFrame, limit: int) -> DataFrame:
    """``lang`` and ``text`` of rows to learn from: of each language an even share of ``limit`` by a hash of doc_id, without a shuffle of texts."""
    known = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, limit / len(counts) / n)).otherwise(share)
    return known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30)).select("lang", "text")


def learn(docs: DataFrame, limit: int = SAMPLE) -> LanguageModel:
    def rows(frames):
        import pyarrow as pa

        for b in frames:
            for at, texts in slices(b):
                x = features(texts).astype(np.float16)
                yield pa.RecordBatch.from_arrays([b.column("lang").slice(at, len(texts)), pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "x"])

    got = sample(docs, limit).mapInArrow(rows, "lang string, x binary").toPandas()
    x = np.frombuffer(b"".join(got["x"]), dtype=np.float16).reshape(-1, DIMS).astype(np.float32)
    order = np.lexsort([got["x"].to_numpy(), got["lang"].to_numpy()]) if len(got) else []
    return fit(x[order], got["lang"].iloc[order].tolist()) if len(got) else LanguageModel()


def identify(docs: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, lang_pred, score``.

    Learns from rows that are not held out and have a language. A NULL text, or one without
    a letter, is ``und`` with score 0, as is every row if there is nothing to learn from. A NULL
    ``doc_id`` is not held out and not learned from.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, limit))

    def run(frames):
        import pyarrow as pa

        model = shared.value
        for b in frames:
            for at, texts in slices(b):
                lang, score = model.predict(features(texts))
                some = [bool(LETTER.search(t)) for t in texts]
                lang = [x if s else "und" for x, s in zip(lang, some, strict=True)]
                score = [float(x) if s else 0.0 for x, s in zip(score, some, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(at, len(texts)), b.column("held_out").slice(at, len(texts)), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), F.col("text"))
    return rows.mapInArrow(run, OUT)
