"""Language-model scoring with a log-bilinear model trained by noise-contrastive estimation.

The model predicts a token's class from the classes of the tokens before it: each position has
a matrix that turns a token's vector into a part of the prediction, and classes are scored by their
product with the prediction. The most frequent words are classes of their own; the others are
parted by their last bytes and, within a class, weighted by their counts over the whole corpus.
So the probabilities of all words and of one unseen word per class add up to one.

Texts are split twice: to count their words, and to write the classes of their tokens, from which the model is
fitted and every text scored. Training starts in one task on documents drawn by a hash of their id, about `warm_tokens`
tokens or half of a small corpus; every task then goes on from that over the other documents it reads, and the
parameters are averaged, weighted by their tokens. So each position of each training document is trained on once, at every size; how documents are
dealt to tasks, and with it the scores, depends on files and task counts. Counts of words cover every training document. The
`table_words` most frequent words are looked up in a broadcast table of that size; counts of all others come by a join.

Defined results: null and empty texts are one end token; rows with a null doc_id are held out; rows are
scored one by one, whatever they share; without training rows every token has the same
probability. Other columns stay, input columns with the names of new ones are replaced.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import add_columns, free_name, map_rows, stage
from tabsmith.llm.wordcounts import count_words, words_of

#: The end of a text; no word is empty.
END = b""


@dataclass(frozen=True)
class Settings:
    """Production settings."""

    word_classes: int = 256
    suffix_classes: int = 64
    table_words: int = 200_000
    context: int = 4
    size: int = 16
    noise: int = 64
    noise_weight: float = 16.0
    batch: int = 2048
    rate: float = 0.1
    warm_tokens: int = 600_000
    held_out_of: int = 10
    smoothing: float = 0.1

    @property
    def classes(self) -> int:
        return self.word_classes + self.suffix_classes


def held_out(column: str, of: int):
    return F.coalesce(F.crc32(F.col(column).cast("string")) % of == 0, F.lit(True))


class Vocabulary:
    """Counts and classes of the frequent words, and the totals of every class."""

    def __init__(self, words: list[bytes], counts: list[int], totals: dict[int, tuple[int, int]], tokens: int, distinct: int, settings: Settings):
        s = self.settings = settings
        self.tokens, self.distinct = tokens, distinct
        self.number = {w: i for i, w in enumerate(words)}  # the end first, then by count
        counts = np.array(counts, float)
        self.class_of = np.array([i if i < s.word_classes else s.word_classes + self.suffix(w) for i, w in enumerate(words)], np.int32)
        sums, kinds = np.zeros(s.classes), np.zeros(s.classes)
        for k, (n, v) in totals.items():
            sums[s.word_classes + k], kinds[s.word_classes + k] = n, v
        for i, w in enumerate(words[:s.word_classes]):
            if i or counts[0]:  # the end counts as a word when there are training rows
                sums[s.word_classes + self.suffix(w)] -= counts[i]
                kinds[s.word_classes + self.suffix(w)] -= 1
            sums[i] = counts[i]
        self.log_count = np.log10(counts + s.smoothing)
        self.base_norm = math.log10(tokens + s.smoothing * (distinct + 1))
        self.class_norm = np.log10(sums + s.smoothing * (kinds + 1))
        self.within = np.where(np.arange(len(words)) < s.word_classes, 0, self.log_count - self.class_norm[self.class_of])
        self.noise = (sums + 1) / (sums + 1).sum()

    def suffix(self, word: bytes) -> int:
        return zlib.crc32(word[-2:]) % self.settings.suffix_classes

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the words and the end after them; -1 where a word is not in the table."""
        get = self.number.get
        return np.array([get(w, -1) for w in words] + [0], np.int64)

    def classes(self, words: list[bytes], numbers: np.ndarray) -> np.ndarray:
        found = self.class_of[numbers]
        for i in np.flatnonzero(numbers < 0).tolist():
            found[i] = self.settings.word_classes + self.suffix(words[i])
        return found


class LogBilinear:
    """Vectors of context and target classes, a matrix per context position, and biases, in single precision."""

    def __init__(self, settings: Settings, noise: np.ndarray, seed: int = 7):
        s, rng = settings, np.random.default_rng(seed)
        self.settings = s
        self.r = (rng.standard_normal((s.classes, s.size)) * 0.1).astype(np.float32)
        self.c = np.stack([np.eye(s.size) * 0.5] * s.context).astype(np.float32)
        self.q = (rng.standard_normal((s.classes, s.size)) * 0.1).astype(np.float32)
        self.b = np.log(noise).astype(np.float32)
        self.log_noise = np.log(noise * s.noise_weight).astype(np.float32)
        self.cumulative = np.cumsum(noise)

    def parameters(self) -> list[np.ndarray]:
        return [self.r, self.c, self.q, self.b]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters()])

    def load(self, flat: np.ndarray) -> LogBilinear:
        at = 0
        for p in self.parameters():
            p[...] = flat[at:at + p.size].reshape(p.shape)
            at += p.size
        return self

    def tables(self) -> np.ndarray:
        """What a class at each context position adds to the prediction."""
        return np.einsum("cd,pde->pce", self.r, self.c, optimize=True)

    def contexts(self, seq: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        return [seq[at - 1 - p] for p in range(self.settings.context)]

    def fit(self, chunks: Iterator[tuple[np.ndarray, np.ndarray]], seed: int) -> int:
        """Noise-contrastive steps (AdaGrad) over (classes, positions); returns the positions seen."""
        s, rng, seen = self.settings, np.random.default_rng(seed), 0
        squares = [np.full(p.shape, 1e-2, np.float32) for p in self.parameters()]
        for seq, positions in chunks:
            rng.shuffle(positions)
            seq = seq.astype(np.intp)
            for begin in range(0, len(positions), s.batch):
                at = positions[begin:begin + s.batch]
                seen += len(at)
                ctx, target = self.contexts(seq, at), seq[at]
                guess = sum(t.take(x, axis=0) for t, x in zip(self.tables(), ctx))
                drawn = np.searchsorted(self.cumulative, rng.random(s.noise)).clip(0, s.classes - 1)
                wanted, bias = self.q.take(target, axis=0), self.b - self.log_noise
                # gradients of the log-likelihood that data are data and noise is noise
                up = 1 / (1 + np.exp(np.clip(np.einsum("bd,bd->b", guess, wanted) + bias[target], -30, 30)))
                down = guess @ self.q[drawn].T
                down += bias[drawn]
                np.clip(down, -30, 30, out=down)
                np.exp(np.negative(down, out=down), out=down)
                down += 1
                np.divide(s.noise_weight / s.noise, down, out=down)
                d_guess = up[:, None] * wanted - down @ self.q[drawn]
                grads = [np.zeros_like(p) for p in self.parameters()]
                for p, x in enumerate(ctx):  # added up by class first, then through the position's matrix
                    sums = np.zeros_like(self.r)
                    _scatter(sums, x, d_guess)
                    grads[0] += sums @ self.c[p].T
                    grads[1][p] = self.r.T @ sums
                _scatter(grads[2], target, up[:, None] * guess)
                np.add.at(grads[2], drawn, -(down.T @ guess))
                grads[3] += np.bincount(target, up, s.classes).astype(np.float32)
                np.add.at(grads[3], drawn, -down.sum(axis=0))
                for param, grad, square in zip(self.parameters(), grads, squares):
                    grad /= len(at)
                    square += grad ** 2
                    param += s.rate * grad / np.sqrt(square)
        return seen

    def log10(self, seq: np.ndarray, at: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of the classes at some positions."""
        out = np.empty(len(at))
        # the bias is one more factor; where no score can be large, exponents need no shift
        factors = np.vstack([self.q.T, self.b])
        reach = np.abs(tables).max(axis=1).sum(axis=0) @ np.abs(self.q).T + np.abs(self.b)
        shifted = not reach.max(initial=0) < 60
        ones = np.ones(len(self.b), np.float32)
        for begin in range(0, len(at), self.settings.batch):
            part = at[begin:begin + self.settings.batch]
            guess = np.ones((len(part), factors.shape[0]), np.float32)
            guess[:, :-1] = sum(tables[p].take(x, axis=0) for p, x in enumerate(self.contexts(seq, part)))
            scores = guess @ factors
            mine = scores[np.arange(len(part)), seq[part]].astype(float)
            if shifted:
                top = scores.max(axis=1)
                scores -= top[:, None]
                mine -= top
            np.exp(scores, out=scores)
            out[begin:begin + len(part)] = mine - np.log((scores @ ones).astype(float))
        return out / math.log(10)


def _scatter(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Add each row of values to a row of `into`."""
    n, size = into.shape
    cells = rows.astype(np.intp)[:, None] * size + np.arange(size)
    into += np.bincount(cells.ravel(), values.ravel(), n * size).reshape(n, size)


def _sequence(found: list[np.ndarray], context: int) -> tuple[np.ndarray, np.ndarray]:
    """Class sequences in one array, each after as many ends as the context has, and the positions of their tokens."""
    sizes = np.array([len(f) for f in found])
    seq = np.zeros(int(sizes.sum()) + context * len(found), np.int16)
    ends = np.cumsum(sizes + context)
    at = np.concatenate([np.arange(e - n, e) for e, n in zip(ends, sizes)])
    seq[at] = np.concatenate(found)
    return seq, at


def build_vocabulary(counts: DataFrame, settings: Settings) -> Vocabulary:
    """From (word, n) of all training tokens; `table_words` rows and one per class come to the driver."""
    s = settings
    kind = F.crc32(F.substring("word", -2, 2)) % s.suffix_classes
    sums = counts.groupBy(kind.alias("kind")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    top = counts.filter(F.length("word") > 0).orderBy(F.desc("n"), "word").limit(s.table_words).toArrow()
    end = counts.filter(F.length("word") == 0).agg(F.sum("n")).first()[0] or 0
    return Vocabulary(
        [END, *map(bytes, top.column("word").to_pylist())], [end, *top.column("n").to_pylist()],
        {r["kind"]: (r["n"], r["v"]) for r in sums}, sum(r["n"] for r in sums), sum(r["v"] for r in sums), s)


def _chunks(batches, context: int, tokens: int):
    """Sequences of about so many tokens and the positions to train on, from batches of (classes,)."""
    held, size = [], 0
    for (sequences,) in batches:
        for classes in sequences:
            held.append(np.frombuffer(classes, np.int16))
            size += len(held[-1])
            if size >= tokens:
                yield _sequence(held, context)
                held, size = [], 0
    if held:
        yield _sequence(held, context)


#: Columns of an encoded table besides those of the documents.
_ENCODED = ("row", "tokens", "known", "base", "own", "rare", "classes", "key", "learnt")


def encode(docs: DataFrame, vocabulary: Vocabulary) -> tuple[DataFrame, dict[str, str]]:
    """`docs` without text, with the classes of the tokens and the parts of the scores that need no model; and these columns' names."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = {n: free_name(docs, n) for n in _ENCODED}

    def run(texts):
        table, out = shared.value, {n: [] for n in ("tokens", "known", "base", "own", "rare", "classes")}
        for text in texts:
            words = words_of(text)
            numbers = table.numbers(words)
            classes = table.classes(words, numbers)
            there = numbers >= 0
            inside = numbers[there]
            rare = Counter([words[i] for i in np.flatnonzero(~there).tolist()])
            out["tokens"].append(len(numbers))
            # an end is known when there are training rows
            out["known"].append(len(inside) - (0 if table.tokens else int((inside == 0).sum())))
            out["base"].append(float(table.log_count[inside].sum()) - len(numbers) * table.base_norm)
            out["own"].append(float(table.within[inside].sum()) - float(table.class_norm[classes[~there]].sum()))
            out["rare"].append([{"word": w, "times": n} for w, n in rare.items()])
            out["classes"].append(classes.astype(np.int16).tobytes())
        return {names[n]: v for n, v in out.items()}

    schema = "{tokens} long, {known} long, {base} double, {own} double, {rare} array<struct<word:binary,times:long>>, {classes} binary"
    key = F.col("doc_id").cast("long")
    named = docs.withColumns({names["key"]: key, names["learnt"]: ~held_out("doc_id", vocabulary.settings.held_out_of)})
    found = add_columns(named, ["text"], run, schema.format(**names)).drop("text")
    return stage(found.withColumn(names["row"], F.monotonically_increasing_id()), "encoded-texts"), names


def fit(encoded: DataFrame, names: dict[str, str], vocabulary: Vocabulary) -> LogBilinear:
    """The model, from the encoded documents that are not held out."""
    s = vocabulary.settings
    learn = encoded.filter(names["learnt"]).select(F.col(names["key"]).alias("key"), F.col(names["classes"]).alias("classes"))

    def steps(start: bytes | None):
        def run(batches):
            from pyspark import TaskContext

            model = LogBilinear(s, noise)
            if start:
                model.load(np.frombuffer(start, np.float32))
            if seen := model.fit(_chunks(batches, s.context, 200_000), seed=TaskContext.get().partitionId()):
                yield {"tokens": [seen], "parameters": [model.flat()]}

        return run

    noise, schema = vocabulary.noise, "tokens long, parameters array<float>"
    share = min(0.5, s.warm_tokens / max(vocabulary.tokens, 1))
    drawn = F.pmod(F.xxhash64(F.lit("warm"), "key"), F.lit(1 << 20)) < int(math.ceil(share * (1 << 20)))
    first = map_rows(learn.filter(drawn).repartition(1), ["classes"], steps(None), schema).collect()  # about warm_tokens
    start = np.array(first[0]["parameters"], np.float32).tobytes() if first else None
    fitted = map_rows(learn.filter(~drawn), ["classes"], steps(start), schema)
    each = fitted.select("tokens", F.posexplode("parameters").alias("at", "value"))
    mean = each.groupBy("at").agg((F.sum(F.col("value").cast("double") * F.col("tokens")) / F.sum("tokens")).alias("value"))
    model = LogBilinear(s, noise)
    if rows := mean.collect():  # a number per parameter
        flat = np.zeros(len(rows), np.float32)
        flat[[r["at"] for r in rows]] = [r["value"] for r in rows]
        model.load(flat)
    elif start:
        model.load(np.frombuffer(start, np.float32))
    return model


def count_training_words(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n) over the documents that are not held out; an empty word counts their ends."""
    learn = docs.filter(~held_out("doc_id", settings.held_out_of)).select("text", F.lit("").alias("grp"))
    return stage(count_words(learn, "grp", extra=[END]).select("word", "n"), "word-counts")


def train(docs: DataFrame, settings: Settings = Settings(), counts: DataFrame | None = None) -> tuple[Vocabulary, LogBilinear, DataFrame]:
    """(vocabulary, model, counts of words) from the documents that are not held out."""
    counts = count_training_words(docs, settings) if counts is None else counts
    vocabulary = build_vocabulary(counts, settings)
    learn = docs.select("doc_id", "text").filter(~held_out("doc_id", settings.held_out_of))
    return vocabulary, fit(*encode(learn, vocabulary), vocabulary), counts


def score_encoded(encoded: DataFrame, names: dict[str, str], vocabulary: Vocabulary, model: LogBilinear, counts: DataFrame) -> DataFrame:
    """The columns of the documents without text, with n_tokens, n_known, train_tokens, base_score and score."""
    new = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    mine = set(names.values())
    kept = [c for c in encoded.columns if c not in mine and c.lower() not in new]
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    context = vocabulary.settings.context
    found = free_name(encoded, "found")

    def run(sequences):
        model_ = shared.value
        tables, out, held, size = model_.tables(), [], [], 0

        def settle():
            seq, at = _sequence(held, context)
            starts = np.concatenate([[0], np.cumsum([len(h) for h in held])[:-1]])
            out.extend(np.add.reduceat(model_.log10(seq, at, tables), starts).tolist())
            held.clear()

        for classes in sequences:
            held.append(np.frombuffer(classes, np.int16))
            size += len(held[-1])
            if size >= 50_000:
                settle()
                size = 0
        if held:
            settle()
        return {found: out}

    col = lambda n: F.col(names[n])
    rare = encoded.select(col("row").alias("row"), F.inline(names["rare"]))
    known = counts.select("word", F.col("n").alias("n"))
    met = rare.join(known, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    late = met.groupBy(F.col("row").alias(names["row"])).agg(
        F.sum(F.col("times") * F.log10(F.col("n") + vocabulary.settings.smoothing)).alias(names["rare"]),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias(names["learnt"]))
    scored = add_columns(encoded.drop(names["rare"], names["learnt"], names["key"]), [names["classes"]], run, f"{found} double").drop(names["classes"])
    joined = scored.join(late, names["row"], "left")
    more = F.coalesce(col("rare"), F.lit(0.0))
    return joined.select(
        *kept, col("tokens").alias("n_tokens"),
        (col("known") + F.coalesce(col("learnt"), F.lit(0))).alias("n_known"), F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (col("base") + more).alias("base_score"), (col("own") + F.col(found) + more).alias("score"))


def score(docs: DataFrame, vocabulary: Vocabulary, model: LogBilinear, counts: DataFrame) -> DataFrame:
    """`docs` without text, with n_tokens, n_known, train_tokens, base_score and score (log10 probabilities of the text)."""
    return score_encoded(*encode(docs, vocabulary), vocabulary, model, counts)


def train_and_score(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """`score` of all documents by a model of those that are not held out; texts are encoded once for both."""
    counts = count_training_words(docs, settings)
    vocabulary = build_vocabulary(counts, settings)
    encoded = encode(docs, vocabulary)
    return score_encoded(*encoded, vocabulary, fit(*encoded, vocabulary), counts)
