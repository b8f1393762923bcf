"""Language identification by segmentation-marginalised unigram models.

Each language is a distribution over the pieces of one fixed public vocabulary. The
probability of a word is the sum over all its segmentations of the product of the
pieces' probabilities (forward algorithm); a text's is the product over its words,
since no piece crosses a white-space boundary. The language with the largest total wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import pieces as P
from .common import id_remainder, slices, text_buffers, with_columns
from .words import Known, distinct, split

#: Labelled texts per language that a model is fitted on; the only bound of this operator.
SAMPLE = 1500
#: Added to each piece's count.
SMOOTHING = 0.05
UNDEFINED = "und"
_RESCALE = 16


def forward(v: P.Pieces, probs: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Log probability of each word (with its word mark) under each language.

    ``probs``: pieces by languages. Words are advanced side by side, one byte a step;
    each step sums over the pieces that end there. Sums are rescaled every few steps,
    so long words do not underflow.
    """
    k = probs.shape[1]
    out = np.empty((len(start), k))
    long = np.flatnonzero(length >= P.LONG)
    for i in long:
        out[i] = forward_long(v, probs, np.concatenate([[np.uint8(32)], data[start[i]:start[i] + length[i]]]))
    short = np.flatnonzero(length < P.LONG)
    for at in P.lanes(length[short] + 1, 1 << 18):
        part = short[at]
        m = P.block(data, start[part], length[part], lead=True)
        size = length[part] + 1
        n, width = m.shape
        alpha = np.zeros((width + 1, n, k))
        alpha[0] = 1.0
        scale = np.zeros((n, k))
        live = 0  # rows are sorted by size: those before ``live`` have ended
        for i in range(1, width + 1):
            h = np.zeros(n - live, np.uint64)
            for back in range(1, min(i, v.longest) + 1):
                h = v.extend(h, m[live:, i - back])
                row = v.rows(h)
                hit = np.flatnonzero(row >= 0)
                if len(hit):
                    alpha[i, live + hit] += alpha[i - back, live + hit] * probs[row[hit]]
            while live < n and size[live] == i:
                live += 1
            done = np.flatnonzero(size == i)
            if len(done):
                out[part[done]] = np.log(alpha[i, done]) + scale[done]
            if i % _RESCALE == 0 and live < n:
                low = max(0, i - v.longest)
                top = alpha[low:i + 1, live:].max(axis=0)
                alpha[low:i + 1, live:] /= top
                scale[live:] += np.log(top)
    return out


def forward_long(v: P.Pieces, probs: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The same for one long word, mark included: the pieces of a stretch are looked up together, then summed byte by byte.

    Only the sums of the last ``longest`` positions are kept from one stretch to the next.
    """
    padded = np.concatenate([probs, np.zeros((1, probs.shape[1]))])  # row -1: no piece
    last = np.zeros((v.longest, probs.shape[1]))
    last[-1] = 1.0
    scale = np.zeros(probs.shape[1])
    for _, rows in P.stretches(v, data):
        alpha = np.concatenate([last, np.zeros((len(rows), probs.shape[1]))])
        weight = padded[rows]
        for i in range(len(rows)):
            end = i + v.longest
            np.einsum("wk,wk->k", alpha[i:end], weight[i], out=alpha[end])
            if i % _RESCALE == 0:
                top = alpha[i + 1:end + 1].max(axis=0)
                alpha[i + 1:end + 1] /= top
                scale += np.log(top)
        last = alpha[len(rows):].copy()
    return np.log(last[-1]) + scale


def fit(df: DataFrame, vocabulary: str, text: str = "text", lang: str = "lang", key: str = "doc_id",
        sample: int = SAMPLE, smoothing: float = SMOOTHING) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities (pieces by languages).

    Counts the pieces of the tokenizer's own segmentation over at most ``sample`` labelled
    texts of each language, those with the smallest hash of their id. Rows with a null
    text or language are not learned from. The result is one count per (language, piece),
    so its size is bounded by the vocabulary and the number of languages.
    """
    rows = (df.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
            .select(F.col(lang).cast("string").alias("lang"), F.col(key).alias("key"), F.col(text).alias("text"))
            .withColumn("draw", F.xxhash64("key")))
    # the smallest hashes lie below a bound that leaves about twice the sample of each language
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    below = F.lit(False)
    for r in sizes:
        share = min(1.0, (2 * sample + 100) / r["n"])
        bound = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
        below = below | ((F.col("lang") == r["lang"]) & (F.col("draw") <= bound))
    pick = Window.partitionBy("lang").orderBy("draw", "key")
    chosen = rows.where(below).withColumn("rank", F.row_number().over(pick)).where(F.col("rank") <= sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        for b in batches:
            names = b.column("lang").to_pylist()
            texts = pc.utf8_lower(b.column("text")).to_pylist()
            total: dict[str, np.ndarray] = {}
            for name, t in zip(names, texts, strict=True):
                at = total.setdefault(name, np.zeros(sp.get_piece_size(), np.int64))
                at += np.bincount(sp.encode(t, num_threads=1), minlength=len(at))
            for name, c in total.items():
                used = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(used)), pa.array(used), pa.array(c[used])], ["lang", "piece", "n"])

    counts = (chosen.select("lang", "text").mapInArrow(count, "lang string, piece long, n long")
              .groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect())
    v = P.load(vocabulary)
    names = sorted({r["lang"] for r in counts})
    at = {name: j for j, name in enumerate(names)}
    c = np.zeros((v.size, len(names)))
    for r in counts:
        c[r["piece"], at[r["lang"]]] += r["n"]
    c = c[v.ids] + smoothing
    return names, c / c.sum(axis=0) if names else c


def identify(df: DataFrame, model: tuple[list[str], np.ndarray], vocabulary: str, text: str = "text",
             lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``df`` with the predicted language and its posterior (uniform prior) for every whole text.

    One pass, no shuffle. A text that is null or has no letter gets ``und`` and score 0, and
    so does every text when no language was learned. The word forms of a slice of rows
    are scored once each. Exact ties go to the language first in code point order. Columns of the new
    ones' names are replaced.
    """
    names, probs = model
    held = df.sparkSession.sparkContext.broadcast(probs)
    schema = df.withColumn(lang_col, F.lit("")).withColumn(score_col, F.lit(0.0)).schema

    def seen(v, known, values, data, w, first) -> np.ndarray:
        """Scores of the slice's word forms, from the task's memo where they are known."""
        h1, h2 = w.h1[first], w.h2[first]
        if known.size > known.most:
            known.clear()
            values[0] = values[0][:0]
        rows = known.find(h1, h2)
        miss = np.flatnonzero(rows < 0)
        start = w.start[first[miss]]
        new = forward(v, held.value, data, start, w.end[first[miss]] - start)
        rows[miss] = known.add(h1[miss], h2[miss])
        values[0] = np.concatenate([values[0], new])
        return values[0][rows]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = P.load(vocabulary)
        known, values = Known(), [np.zeros((0, len(names)))]
        for b in slices(batches, text, 1 << 20):
            col = b.column(b.schema.get_field_index(text))
            letters = pc.fill_null(pc.match_substring_regex(col, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            data, off = text_buffers(pc.utf8_lower(col))
            total = np.zeros((b.num_rows, len(names)))
            w = split(data, off)
            if len(w.start) and names:
                first, inverse = distinct(w.h1, w.h2)
                ll = seen(v, known, values, data, w, first)
                for j in range(len(names)):
                    total[:, j] = np.bincount(w.doc, weights=ll[inverse, j], minlength=b.num_rows)
            if names:
                best = total.argmax(axis=1)
                post = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            ok = letters & bool(names)
            pred = [names[best[i]] if ok[i] else UNDEFINED for i in range(b.num_rows)]
            sure = np.where(ok, post if names else 0.0, 0.0)
            yield with_columns(b, schema.names, {lang_col: pa.array(pred, pa.string()), score_col: pa.array(sure)})

    return df.mapInArrow(score, schema)


def query(spark, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """op1: the language of every document, learned from the folds that are not held out."""
    from .common import table

    vocabulary = vocabulary or P.default_vocabulary()
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(id_remainder("doc_id", 4) != 2), vocabulary)
    rows = docs.select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "text")
    return identify(rows, model, vocabulary).select("doc_id", "held_out", "lang_pred", "score")
