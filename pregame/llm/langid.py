"""Language identification by words first, character n-grams for the rest.

A word the model knows is scored by its log frequency in each language.  An
unseen word backs off: the longest n-gram order (from ``ORDERS[0]`` down) of
which the model knows any of the word's n-grams scores it, by their mean log
frequency.  Words are letter runs of the lower-cased text; the whole text
counts.  Every word's scores become log posteriors over the languages; a
text's language has the largest sum over its words, and its score is that
language's mean posterior over them (0 to 1).  Its certainty is the language's
posterior given the whole text, from the same sums.

The model is fitted on a bounded sample of labelled texts: per language about
``sample_texts`` distinct texts, those of the smallest content hashes, so the
choice is the same on any cluster and a copied text counts once.  It knows the
``table_size`` most frequent entries of every language and order, with their
counts in all languages; frequencies are shares of all counts of the sample.  Every
label is a language, however many there are; with many of them ``table_size``
shrinks so that the model stays within ``MODEL_CELLS`` numbers (10,000 entries
up to 21 languages, 700 at 80), which bounds the broadcast.  Prediction is one pass
over Arrow batches without a shuffle, and sees the text alone.

Edge cases: a null text or one without letters is ``und`` with score 0; so is
every text if no labelled text exists; rows with a null language are not
learned from; ties go to the language first in order of name; repeated rows get
equal results; very long texts count whole; extra columns, whatever their names,
are ignored by ``identify`` and kept by ``predict`` (those named like an output are
replaced) and ``keep_identified``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_text, quoted, replacing, text_slices

ORDERS = (5, 4, 3, 2, 1)
SAMPLE_TEXTS = 4000
TABLE_SIZE = 10_000
MODEL_CELLS = 1 << 25  # numbers of the model (4 bytes each), at most
MEMO_BYTES = 24 << 20  # of words whose posteriors a task keeps
MIN_CERTAINTY = 0.5
UNDETERMINED = "und"


def words_of(text: str) -> list[str]:
    import re
    return re.findall(r"[^\W\d_]+", text.lower())


def _word_counts(batches):
    """(text, lang) -> (lang, word, n) of each slice."""
    from collections import Counter, defaultdict

    import pyarrow as pa
    for part, texts in text_slices(batches):
        by: dict = defaultdict(Counter)
        for lang, t in zip(part.column(1).to_pylist(), texts):
            by[lang].update(words_of(t.decode("utf-8", "replace")))
        rows = [(lang, w, n) for lang, c in by.items() for w, n in c.items() if w.isalpha()]
        cols = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
                                          pa.array(cols[2], pa.int64())], ["lang", "word", "n"])


def sample(docs: DataFrame, texts: int = SAMPLE_TEXTS) -> DataFrame:
    """About ``texts`` distinct labelled texts of every language: (lang, text)."""
    d = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", F.xxhash64("text").alias("_h"))
    sizes = d.groupBy("lang").agg(F.approx_count_distinct("_h", 0.02).alias("n"))
    # one row a label
    shares = {r.lang: min(1.0, texts / max(r.n, 1)) for r in sizes.collect()}
    if not shares:
        return d.select("lang", "text").limit(0)
    share = F.create_map(*[F.lit(x) for kv in sorted(shares.items()) for x in kv])[F.col("lang")]
    return (d.filter(F.pmod("_h", F.lit(1 << 30)) < share * (1 << 30))
            .dropDuplicates(["lang", "_h"]).select("lang", "text"))


def entries(languages: int, table_size: int = TABLE_SIZE, cells: int = MODEL_CELLS) -> int:
    """Entries of each language and order that the model has room for."""
    return max(1, min(table_size, cells // (languages ** 2 * (1 + len(ORDERS)))))


def train(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS, table_size: int = TABLE_SIZE, cells: int = MODEL_CELLS) -> dict:
    """Model: languages; for words (order 0) and every n-gram order its grams, one a
    line; and a matrix of their log frequencies (order after order), by language."""
    import numpy as np
    counts = (sample(docs, sample_texts).select(F.col("text").cast("binary"), "lang")
              .mapInArrow(_word_counts, "lang string, word string, n long")
              .groupBy("lang", "word").agg(F.sum("n").alias("n")).persist())
    padded = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    lengths = F.sequence(F.lit(min(ORDERS)), F.least(F.length(padded), F.lit(max(ORDERS))))
    grams = F.flatten(F.transform(lengths, lambda k: F.transform(
        F.sequence(F.lit(1), F.length(padded) - k + 1), lambda i: F.struct(k.alias("k"), F.substring(padded, i, k).alias("gram")))))
    parts = counts.select("lang", "n", F.inline(grams)).groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))
    every = counts.filter("n > 1").select("lang", F.lit(0).alias("k"), F.col("word").alias("gram"), "n").union(
        parts.select("lang", "k", "gram", "n")).persist()
    langs = sorted(r.lang for r in every.select("lang").distinct().collect())
    if not langs:
        return {"langs": [], "grams": {}, "logs": np.zeros((0, 0), np.float32)}
    w = Window.partitionBy("lang", "k").orderBy(F.desc("n"), "gram")  # groups are bounded by the sample
    top = every.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= entries(len(langs), table_size, cells))
    known = every.join(top.select("k", "gram").distinct(), ["k", "gram"], "left_semi")
    got = known.select("k", "gram", "lang", "n").orderBy("k", "gram").toArrow()
    totals = {(r.k, r.lang): r.n for r in every.groupBy("k", "lang").agg(F.sum("n").alias("n")).collect()}
    every.unpersist()
    counts.unpersist()
    at = {lang: i for i, lang in enumerate(langs)}
    out: dict = {"langs": langs, "grams": {}}
    orders, names = got.column("k").to_numpy(), got.column("gram").to_pylist()
    place = np.fromiter(map(at.__getitem__, got.column("lang").to_pylist()), np.int64, len(names))
    n, tables = got.column("n").to_numpy(), []
    for k in sorted({int(k) for k in orders}):
        here = np.flatnonzero(orders == k)
        own = list(dict.fromkeys(names[i] for i in here))
        row = dict(zip(own, range(len(own))))
        table = np.zeros((len(own), len(langs)))
        table[[row[names[i]] for i in here], place[here]] = n[here]
        every_n = np.array([totals.get((k, lang), 0) for lang in langs])
        # one half for each entry, and for all that is not known together
        tables.append(np.log((table + 0.5) / (every_n + 0.5 * (len(own) + 1))).astype(np.float32))
        out["grams"][k] = "\n".join(own)
    out["logs"] = np.concatenate(tables)
    return out


class Scorer:
    """Log posteriors of words and texts under a model."""

    def __init__(self, model: dict, memo_bytes: int | None = None):
        import numpy as np
        self.np, self.langs = np, model["langs"]
        # the matrix's last row knows nothing
        self.at: dict[int, dict[str, int]] = {}
        start = 0
        for k, grams in model["grams"].items():
            own = grams.split("\n")
            self.at[k] = dict(zip(own, range(start, start + len(own))))
            start += len(own)
        self.logs = np.concatenate((model["logs"], np.zeros((1, len(self.langs)), np.float32)))
        # a word, its place in a dict and its row
        self.most = max(1, (memo_bytes or MEMO_BYTES) // (180 + 4 * len(self.langs)))
        self.forget()

    def forget(self):
        self.rows: dict[str, int] = {}
        self.table = self.np.zeros((1 << 12, len(self.langs)), self.np.float32)

    def evidence(self, word: str) -> list[int]:
        """Rows that score a word: its own, or those of its longest known n-grams."""
        own = self.at.get(0, {}).get(word)
        if own is not None:
            return [own]
        padded = f"^{word}$"
        for k in ORDERS:
            known = self.at.get(k)
            if known:
                found = [r for r in [known.get(padded[i:i + k]) for i in range(len(padded) - k + 1)] if r is not None]
                if found:
                    return found
        return [len(self.logs) - 1]

    def log_posteriors(self, words):
        np = self.np
        rows = [self.evidence(w) for w in words]
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.fromiter((r for x in rows for r in x), np.int64, int(sizes.sum()))
        v = np.add.reduceat(self.logs[flat].astype(np.float64), np.cumsum(sizes) - sizes) / sizes[:, None]
        v -= v.max(axis=1, keepdims=True)
        return v - np.log(np.exp(v).sum(axis=1, keepdims=True))

    def learn(self, words: list[str]):
        """Keeps the posteriors of words not seen before."""
        np = self.np
        start = len(self.rows)
        self.rows.update(zip(words, range(start, start + len(words))))
        while len(self.table) < len(self.rows):
            self.table = np.concatenate((self.table, np.zeros_like(self.table)))
        self.table[start:len(self.rows)] = self.log_posteriors(words)

    def texts(self, texts) -> list[tuple[str, float, float]]:
        """(language, score, certainty) of every text."""
        from collections import Counter
        np = self.np
        counts = [Counter(words_of(t)) if t else {} for t in texts]
        none = (UNDETERMINED, 0.0, 0.0)
        if not self.langs:
            return [none] * len(counts)
        if len(self.rows) > self.most:
            self.forget()
        unseen = dict.fromkeys(w for c in counts for w in c if w not in self.rows)
        if unseen:
            self.learn(list(unseen))
        out = []
        for c in counts:
            if not c or not any(any(map(str.isalpha, w)) for w in c):
                out.append(none)
                continue
            logs = self.table[list(map(self.rows.__getitem__, c))]
            n = np.fromiter(c.values(), np.float64, len(c))
            sums = n @ logs
            best = int(np.argmax(sums))
            out.append((self.langs[best], float(min(1.0, n @ np.exp(logs[:, best]) / n.sum())),
                        float(1 / np.exp(sums - sums[best]).sum())))
        return out


def _predictor(model, least: float | None):
    """The text is the first column and left out: the others, lang_pred and score of
    every row; or, with ``least``, all columns of the rows at least that certain."""
    def run(batches):
        import pyarrow as pa
        scorer = Scorer(model.value)
        for part, texts in text_slices(batches, limit=1 << 20):
            got = scorer.texts([None if t is None else t.decode("utf-8", "replace") for t in texts])
            if least is None:
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())],
                    [*part.schema.names[1:], "lang_pred", "score"])
            else:
                yield part.filter(pa.array([x[0] != UNDETERMINED and x[2] >= least for x in got], pa.bool_()))
        pa.default_memory_pool().release_unused()
    return run


def _first(docs: DataFrame, text_col: str, rest: list[str]) -> DataFrame:
    return docs.select(F.col(quoted(text_col)).cast("string").alias("_text"), *[F.col(quoted(c)) for c in rest])


def predict(docs: DataFrame, model: dict, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all of them) plus lang_pred and score."""
    d = _first(docs, text_col, replacing(docs, ["lang_pred", "score"]).columns if keep is None else keep)
    schema = T.StructType([*d.schema.fields[1:], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return d.mapInArrow(_predictor(docs.sparkSession.sparkContext.broadcast(model), None), schema)


def held_out(id_col: str = "doc_id") -> Column:
    return crc_text(id_col) % 4 == 2


def identify(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learned from the
    labelled documents that are not held out."""
    model = train(docs.filter(~held_out()), **options)
    out = predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, min_certainty: float = MIN_CERTAINTY, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the texts that have no language, or none that their words
    together speak for."""
    model = train(docs.select("lang", F.col(quoted(text_col)).alias("text")), **options)
    rest = [c for c in docs.columns if c != text_col]
    d = _first(docs, text_col, rest).toDF(*[f"c{i}" for i in range(len(docs.columns))])
    out = d.mapInArrow(_predictor(docs.sparkSession.sparkContext.broadcast(model), min_certainty), d.schema)
    place = {c: i for i, c in enumerate([text_col, *rest])}
    return out.select(*[F.col(f"c{place[c]}").alias(c) for c in docs.columns])
