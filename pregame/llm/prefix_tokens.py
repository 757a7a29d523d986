"""Exact token counts of every prefix by dynamic programming.

For a byte-pair vocabulary, the last token of a prefix's encoding follows from
shorter prefixes: token t ends the encoding of a prefix exactly if the encoding
of what stands before t ends in a token u such that u and t, side by side,
never merge over their border.  Exactly one t does.  So one pass over a text
stores (count, last token) for every prefix, and truncation and budget
questions are answered from the stored counts, without encoding anything again
(``tokens_in_prefix``, ``longest_prefix_within``).

Whether u and t merge over their border is decided by their spines: the pieces
that stand at the border while u and t are being built, each with the rank of
the merge that ends it.

No vocabulary piece holds a space sign after another character, and a line
break is in no longer piece, so encodings never cross those places: a text is a
chain of segments, whose prefix states are shared by all texts of a task (a
memo of bounded size).  Characters outside the vocabulary count as their UTF-8
bytes (byte fallback).  Texts are never cut and nothing is shuffled.

Edge cases: a null text is the empty text (no tokens); control strings such as
``</s>`` in a text are ordinary text, as in the library; repeated rows give
repeated results; a null doc_id is kept; an empty table gives an empty result;
columns beyond id and text are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_lists, quoted

LIMIT = 4096
SPACE_SIGN = "▁"
MEMO = 2_000_000  # prefixes a task keeps
LONG = 48  # segments of more characters are not kept


def vocabulary_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _build(piece: str, rank: dict[str, int]):
    """(left, right) of the merge that makes ``piece`` out of its characters, or
    None if merging never arrives at it."""
    parts = list(piece)
    while len(parts) > 2:
        best = min(range(len(parts) - 1), key=lambda i: rank.get(parts[i] + parts[i + 1], 1 << 30))
        if parts[best] + parts[best + 1] not in rank:
            return None
        parts[best:best + 2] = [parts[best] + parts[best + 1]]
    return tuple(parts)


def spines(path: str) -> dict:
    """What the workers need of a sentencepiece BPE model: ranks, and for every
    reachable piece its left and right spine [(part, rank that ends it)]."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    usable = [i for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    order = sorted(usable, key=lambda i: (-sp.get_score(i), i))
    rank = {sp.id_to_piece(i): r for r, i in enumerate(order)}
    split = {p: (None if len(p) == 1 else _build(p, rank)) for p in rank}
    left: dict[str, list] = {}
    right: dict[str, list] = {}
    for p in sorted(rank, key=len):
        if len(p) == 1:
            left[p] = right[p] = [(p, 1 << 30)]
        elif split[p] and all(x in left for x in split[p]):
            a, b = split[p]
            left[p] = left[a][:-1] + [(a, rank[p]), (p, 1 << 30)]
            right[p] = right[b][:-1] + [(b, rank[p]), (p, 1 << 30)]
    joined = {c for p in rank if len(p) > 1 for c in p}
    return {"rank": {p: r for p, r in rank.items() if len(p) > 1}, "left": left, "right": right,
            "longest": max(map(len, rank), default=1),
            "alone": [c for c in "\n\t\r" if c not in joined],
            "words": not any(SPACE_SIGN in p.lstrip(SPACE_SIGN) for p in rank)}


class _Totals(dict):
    """segment -> tokens, worked out once."""

    def __init__(self, last_state):
        self.last_state = last_state

    def __missing__(self, segment: str) -> int:
        found = self.last_state(segment)[0]
        if len(segment) <= LONG:
            self[segment] = found
        return found


class PrefixCounter:
    """Prefix states of texts under one vocabulary (``spines``)."""

    def __init__(self, model: dict):
        import re
        self.rank, self.left, self.right, self.longest = model["rank"], model["left"], model["right"], model["longest"]
        self.memo: dict[str, tuple[int, str]] = {}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.totals = _Totals(self.last_state)
        alone = "".join(model["alone"])
        self.segments = re.compile(
            f"{SPACE_SIGN}+[^{SPACE_SIGN}{alone}]*|[^{SPACE_SIGN}{alone}]+" + (f"|[{alone}]" if alone else "")
            if model["words"] else "(?s:.+)").findall

    def apart(self, u: str, t: str) -> bool:
        """Do u and t, each built from its characters, stay unmerged?"""
        a, b = self.right.get(u) or [(u, 1 << 30)], self.left.get(t) or [(t, 1 << 30)]
        i = j = 0
        while True:
            (x, x_end), (y, y_end) = a[i], b[j]
            merge = self.rank.get(x + y)
            # equal ranks merge from the left: first inside u, then over the border, then inside t
            if merge is not None and merge < x_end and merge <= y_end:
                return False
            if x_end <= y_end:
                i += 1
            else:
                j += 1
            if i == len(a) or j == len(b):
                return True

    def step(self, text: str, end: int, before: tuple[int, str], state) -> tuple[int, str]:
        """State of text[:end] after ``before``, that of text[:end - 1];
        ``state(i)`` gives that of text[:i]."""
        # exactly one start is right, so the likely ones come first: the last
        # token grown by a character, the character alone, then the others
        n, last = before
        char = text[end - 1]
        grown = last + char
        if grown in self.left:
            start = end - len(grown)
            if not start:
                return 1, grown
            m, u = state(start)
            if self.fits(u, grown):
                return m + 1, grown
        if self.fits(last, char):
            return n + (1 if char in self.left else len(char.encode("utf-8", "surrogatepass"))), char
        for start in range(max(0, end - self.longest), end - 1):
            t = text[start:end]
            if t in self.left:
                if not start:
                    return 1, t
                m, u = state(start)
                if self.fits(u, t):
                    return m + 1, t
        raise AssertionError("a prefix has no last token")

    def fits(self, u: str, t: str) -> bool:
        known = self.pairs.get(u)
        if known is None:
            known = self.pairs[u] = {}
        found = known.get(t)
        if found is None:
            found = known[t] = self.apart(u, t)
        return found

    def first(self, char: str) -> tuple[int, str]:
        return (1 if char in self.left else len(char.encode("utf-8", "surrogatepass"))), char

    def states(self, segment: str) -> list[tuple[int, str]]:
        """(count, last token) of every prefix of a segment, from length 1 on."""
        out = [self.first(segment[0])]
        for end in range(2, len(segment) + 1):
            out.append(self.step(segment, end, out[-1], lambda i: out[i - 1]))
        return out

    def last_state(self, segment: str) -> tuple[int, str]:
        """State of a whole segment, from the longest prefix that is known."""
        memo, size = self.memo, len(segment)
        if size > LONG:
            return self.states(segment)[-1]
        known, found = size, memo.get(segment)
        while found is None and known > 1:
            known -= 1
            found = memo.get(segment[:known])
        if found is None:
            found = memo[segment[0]] = self.first(segment[0])

        def state(i):
            return memo.get(segment[:i]) or self.last_state(segment[:i])

        for end in range(known + 1, size + 1):
            found = memo[segment[:end]] = self.step(segment, end, found, state)
        return found

    def split(self, text: str) -> list[str]:
        if len(self.memo) > MEMO:
            self.memo.clear()
            self.totals.clear()
            self.pairs.clear()
        return self.segments(SPACE_SIGN + text.replace(" ", SPACE_SIGN)) if text else []

    def count(self, text: str) -> int:
        """Tokens of the whole text: the count stored at its last prefix."""
        return sum(map(self.totals.__getitem__, self.split(text)))

    def prefix_counts(self, text: str) -> list[int]:
        """Tokens of text[:i] for i = 0 to len(text)."""
        out, before = [0], 0
        for s in self.split(text):
            counts = [before + n for n, _ in self.states(s)]
            out += counts
            before = counts[-1]
        return [0] + out[2:] if text else [0]  # the first sign is the added space, no prefix of the text


def _counts(model, every_prefix: bool):
    def run(batches):
        import pyarrow as pa
        counter = PrefixCounter(model.value)
        for batch in batches:
            texts = byte_lists(batch.column(0))
            size = pa.array([len(t or b"") for t in texts], pa.int64())
            plain = ((t or b"").decode("utf-8", "replace") for t in texts)
            if every_prefix:
                table = [counter.prefix_counts(t) for t in plain]
                cols = [pa.array([c[-1] for c in table], pa.int64()), pa.array(table, pa.list_(pa.int32()))]
            else:
                cols = [pa.array([counter.count(t) for t in plain], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], size, *cols], [
                *batch.schema.names[1:], "n_bytes", "n_tokens", *(["prefix_tokens"] if every_prefix else [])])
    return run


def count_tokens(docs: DataFrame, vocabulary: str | None = None, every_prefix: bool = False,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every text; with ``every_prefix`` also
    prefix_tokens: the counts of all its prefixes, by characters from 0 on."""
    model = docs.sparkSession.sparkContext.broadcast(spines(vocabulary or vocabulary_file()))
    d = docs.select(F.col(quoted(text_col)).cast("binary").alias("_text"), F.col(quoted(id_col)))
    fields = [d.schema[1], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    if every_prefix:
        fields.append(T.StructField("prefix_tokens", T.ArrayType(T.IntegerType())))
    return d.mapInArrow(_counts(model, every_prefix), T.StructType(fields))


def tokens_in_prefix(prefix_tokens: Column, chars: Column) -> Column:
    """Exact token count of a text's first ``chars`` characters."""
    return F.element_at(prefix_tokens, F.least(chars, F.size(prefix_tokens) - 1).cast("int") + 1)


def longest_prefix_within(prefix_tokens: Column, budget: Column) -> Column:
    """Most characters whose tokens stay within ``budget`` (counts can fall by a
    further character, so this is the last such prefix, not the first stop)."""
    fits = F.transform(prefix_tokens, lambda n, i: F.when(n <= budget, i))
    return F.coalesce(F.array_max(fits), F.lit(0)).cast("long")


def token_report(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    return count_tokens(docs.select("doc_id", "text")).withColumn("over_limit", F.col("n_tokens") > limit)
