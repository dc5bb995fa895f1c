"""Language-model scoring from a log-frequency Bloom filter.

N-gram counts (words and word pairs of all training texts) are quantised to
1 + floor(log2(count)) and held in a Bloom filter: an n-gram of level q is
entered once for each level 1..q.  A count is read back by probing level after
level until one is missing, and smoothed: a word's probability is its pair count
with Dirichlet prior mass on the add-one unigram probability.

Counting runs in Spark: tasks count in numpy and deal their n-grams by segment
(the top bits of the hash) in packed rows; a segment's counts are summed in one
group, whose size the number of segments bounds, and become its stretch of the
filter.  The filter grows with the corpus, so its error rate does not; it stays
in the shared folder and is never gathered.  The most frequent n-grams, at most
``TABLE``, go to the workers with their levels.  Scoring packs texts into chunks;
a chunk asks each segment once for its other distinct n-grams there, the segment
answers with their levels, and the chunk's texts are scored from the answers.

The base score needs exact counts of words.  The most frequent words, at most
``TABLE``, go to the workers as a sorted table; all others are joined by hash.

Defined cases: a null text is empty; an empty text has its end as only token;
A-Z count as a-z; null ids count as empty text in ``held_out``; repeated rows
are texts of their own; without training rows every count is 0; words of equal
count are in the table of frequent ones together or not at all; a very long text
is read whole, as a chunk of its own if need be; an empty table gives an empty
result; columns other than doc_id, held_out and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import BYTE_CODE_LOWER, arrow_task, id_remainder, materialize, mix64, prefix_hash, span_hash, steps, utf8, word_bounds

#: Bits of the filter for a byte of training text, at least.
BITS_PER_BYTE = 2
#: Training text of a segment, about.
SEGMENT_BYTES = 2 << 20
#: Text that asks the filter at once, about, and asking text for a segment's share of a group.
CHUNK_BYTES, ASK_BYTES = 4 << 20, 8 << 20
PROBES = 3
#: Words with exact counts on every worker, and n-grams with their levels.
TABLE = 1 << 20
#: Prior mass of the unigram probability in a word's context.
PRIOR = 16.0
#: Tokens that a task counts before it passes them on.
HOLD = 1 << 21

START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_PAIR, _LEVEL, _PROBE = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3)
_KEY_BYTES = 5
_LOW = np.uint64((1 << 8 * _KEY_BYTES) - 1)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all texts (words, then an end for each text), the token
    before each one, and the n+1 token offsets of the texts."""
    starts, ends, at = word_bounds(data, offsets)
    h = span_hash(prefix_hash(data, BYTE_CODE_LOWER), starts, ends)
    n = len(offsets) - 1
    bounds = at + np.arange(n + 1)
    token = np.empty(bounds[-1], np.uint64)
    is_end = np.zeros(len(token), bool)
    is_end[bounds[1:] - 1] = True
    token[is_end], token[~is_end] = END, h
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[bounds[:-1]] = START
    return token, before, bounds


def pair_keys(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix64(before * _PAIR + token)


def filter_keys(h: np.ndarray, segment_bits: int) -> np.ndarray:
    """What of a hash the filter keeps: its segment and 40 more bits."""
    shift = np.uint64(64 - segment_bits)
    return (h >> shift << shift | h & _LOW) if segment_bits else h & _LOW


def _pack(keys: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES]


def _unpack(raw: bytes, segment: int, segment_bits: int) -> np.ndarray:
    out = np.zeros((len(raw) // _KEY_BYTES, 8), np.uint8)
    out[:, :_KEY_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, _KEY_BYTES)
    return out.view(np.uint64).reshape(-1) | np.uint64(segment << (64 - segment_bits) if segment_bits else 0)


def _count(segment_bits: int):
    edges = np.arange(1, 1 << segment_bits, dtype=np.uint64) << np.uint64(64 - segment_bits) if segment_bits else np.zeros(0, np.uint64)

    def flush(single: list[np.ndarray], pair: list[np.ndarray]) -> pa.RecordBatch:
        word, n_word = np.unique(np.concatenate(single), return_counts=True)
        both, n_both = np.unique(np.concatenate(pair), return_counts=True)
        more = n_both > 1
        cut = lambda keys: np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)
        columns = {}
        for name, keys, values, width in (
            ("words", word, word.astype(np.uint64).view(np.uint8), 8), ("word_counts", word, n_word.astype(np.int64).view(np.uint8), 8),
            ("once", both[~more], _pack(both[~more]).reshape(-1), _KEY_BYTES),
            ("pairs", both[more], _pack(both[more]).reshape(-1), _KEY_BYTES), ("pair_counts", both[more], n_both[more].astype(np.int64).view(np.uint8), 8),
        ):
            at = cut(keys) * width
            columns[name] = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])
        return pa.RecordBatch.from_pydict({"segment": pa.array(np.arange(1 << segment_bits, dtype=np.int32)), **columns})

    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single, pair, held = [], [], 0
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, j in steps(offsets):
                token, before, _ = tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                single.append(token)
                pair.append(filter_keys(pair_keys(before, token), segment_bits))
                held += len(token)
                if held >= HOLD:
                    yield flush(single, pair)
                    single, pair, held = [], [], 0
        if held:
            yield flush(single, pair)

    return run


def _totals(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[starts], np.add.reduceat(counts, starts)


def _positions(keys: np.ndarray, level: int, probe: int, segment_size: int) -> np.ndarray:
    salt = np.uint64((level * int(_LEVEL) + probe * int(_PROBE)) % (1 << 64))
    return (mix64(keys + salt) >> np.uint64(20)) % np.uint64(segment_size)


def _sum_segment(segment_bits: int, segment_size: int, most: int):
    def run(table: pa.Table) -> pa.Table:
        segment = table.column("segment")[0].as_py()
        joined = lambda name: b"".join(table.column(name).to_pylist())
        words, n_words = _totals(np.frombuffer(joined("words"), np.uint64), np.frombuffer(joined("word_counts"), np.int64))
        once, pairs = _unpack(joined("once"), segment, segment_bits), _unpack(joined("pairs"), segment, segment_bits)
        both, n_both = _totals(np.concatenate([once, pairs]), np.concatenate([np.ones(len(once), np.int64), np.frombuffer(joined("pair_counts"), np.int64)]))
        bits = np.zeros(segment_size, bool)
        top, top_levels = [], []
        for keys, counts in ((filter_keys(words, segment_bits), n_words), (both, n_both)):
            level = np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1
            top.append(keys)
            top_levels.append(level.astype(np.uint8))
            for q in range(1, int(level.max(initial=0)) + 1):
                keys, level = keys[level >= q], level[level >= q]
                for probe in range(PROBES):
                    bits[_positions(keys, q, probe, segment_size)] = True
        # the top takes whole octaves, at most ``most`` n-grams
        top, top_levels = np.concatenate(top), np.concatenate(top_levels)
        over = np.cumsum(np.bincount(top_levels, minlength=66)[::-1])[::-1]
        on = top_levels >= np.flatnonzero(over <= most)[0]
        return pa.table({
            "segment": pa.array([segment], pa.int32()), "bits": [np.packbits(bits, bitorder="little").tobytes()],
            "top": [top[on].tobytes()], "top_levels": [top_levels[on].tobytes()],
            "words": [words.tobytes()], "word_counts": [n_words.tobytes()],
            "n_tokens": pa.array([int(n_words.sum())]), "n_types": pa.array([len(words)]), "n_pairs": pa.array([len(both)]),
            "levels": pa.array([np.bincount(np.floor(np.log2(np.maximum(n_words, 1))).astype(np.int64), minlength=64).tolist()], pa.list_(pa.int64())),
        })

    return run


def _levels(bits: np.ndarray, keys: np.ndarray, segment_size: int) -> np.ndarray:
    """Quantised counts of a segment's n-grams: levels held, probed one after the other."""
    out, live = np.zeros(len(keys), np.uint8), np.arange(len(keys))
    q = 1
    while len(live) and q <= 64:
        for probe in range(PROBES):
            at = _positions(keys[live], q, probe, segment_size)
            live = live[(bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0]
        out[live] = q
        q += 1
    return out


class Table:
    """What every worker gets for scoring: sizes, exact counts of the frequent
    words, and levels of the frequent n-grams."""

    def __init__(self, segment_bits: int, n_tokens: int, n_types: int, n_texts: int, words: np.ndarray, counts: np.ndarray, top: np.ndarray, top_levels: np.ndarray):
        self.segment_bits, self.n_tokens, self.n_types, self.n_texts = segment_bits, n_tokens, n_types, n_texts
        self.words, self.counts, self.top, self.top_levels = words, counts, top, top_levels

    def asked(self, token: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct keys of all n-grams of a chunk, so by segment, their levels
        so far, and which of them the segments are asked for."""
        word = np.unique(np.append(token, before))
        keys = np.unique(np.concatenate([filter_keys(word, self.segment_bits), filter_keys(pair_keys(before, token), self.segment_bits)]))
        if not len(self.top):
            return keys, np.zeros(len(keys), np.uint8), np.ones(len(keys), bool)
        place = np.minimum(np.searchsorted(self.top, keys), len(self.top) - 1)
        held = self.top[place] == keys
        return keys, np.where(held, self.top_levels[place], 0).astype(np.uint8), ~held

    def log_probabilities(self, token: np.ndarray, before: np.ndarray, keys: np.ndarray, levels: np.ndarray) -> np.ndarray:
        """log10 of the smoothed probability of each token after the one before,
        from the keys of all n-grams and their levels."""
        # expected counts of the levels: 0, 1, then the middle of each octave
        counts = np.where(levels < 2, levels, 1.5 * 2.0 ** (levels.astype(np.float64) - 1))
        count = lambda h: counts[np.searchsorted(keys, filter_keys(h, self.segment_bits))]
        word, where = np.unique(np.append(token, before), return_inverse=True)
        own = count(word)
        own[word == START] = self.n_texts
        word_count, context = own[where[: len(token)]], own[where[len(token) :]]
        single = (word_count + 1) / (self.n_tokens + self.n_types + 1)
        pair = np.minimum(count(pair_keys(before, token)), np.minimum(context, np.maximum(word_count, 1)))
        return np.log10(np.minimum((pair + PRIOR * single) / (context + PRIOR), 1.0))


class Model:
    """The filter's segments in the shared folder, and the table."""

    def __init__(self, segments: DataFrame, segment_size: int, table: Table):
        self.segments, self.segment_size, self.table = segments, segment_size, table
        self.segment_bits, self.n_tokens, self.n_types = table.segment_bits, table.n_tokens, table.n_types

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Levels of a few keys, from the segments that hold them."""
        segment = (keys >> np.uint64(64 - self.segment_bits)).astype(np.int64)
        out = np.zeros(len(keys), np.int64)
        for row in self.segments.where(F.col("segment").isin(np.unique(segment).tolist())).select("segment", "bits").toLocalIterator():
            on = segment == row["segment"]
            out[on] = _levels(np.frombuffer(row["bits"], np.uint8), keys[on], self.segment_size)
        return out


def train(texts: DataFrame) -> tuple[Model, DataFrame]:
    """The model of all rows of (text), and the counted segments (exact word counts)."""
    size, n_texts = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    segment_bits = min(20, max(2, int(size // SEGMENT_BYTES).bit_length()))
    total_bits = max(1 << 16, 1 << int(size * BITS_PER_BYTE).bit_length())
    segment_size = max(64, total_bits >> segment_bits)
    packed = texts.select("text").mapInArrow(_count(segment_bits), "segment int, words binary, word_counts binary, once binary, pairs binary, pair_counts binary")
    segments = materialize(
        packed.groupBy("segment").applyInArrow(
            _sum_segment(segment_bits, segment_size, TABLE >> segment_bits),
            "segment int, bits binary, top binary, top_levels binary, words binary, word_counts binary, n_tokens bigint, n_types bigint, n_pairs bigint, levels array<bigint>",
        ),
        "bloom-segments",
    )
    n_tokens, n_types = segments.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_types"), F.lit(0))).first()
    # the table takes whole octaves of counts, from the top
    octaves = dict(segments.select(F.posexplode("levels").alias("q", "n")).groupBy("q").agg(F.sum("n")).collect())
    least, held = 64, 0
    while least > 0 and held + octaves.get(least - 1, 0) <= TABLE:
        least -= 1
        held += octaves.get(least, 0)
    frequent = segments.select("words", "word_counts").mapInArrow(_listed(1 << least if least < 62 else 1 << 62, None), "word bigint, n bigint").toArrow()
    words = frequent.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    top = segments.select("segment", "top", "top_levels").toArrow().sort_by("segment")
    keys, levels = (np.frombuffer(b"".join(top.column(c).to_pylist()), kind) for c, kind in (("top", np.uint64), ("top_levels", np.uint8)))
    by_key = np.argsort(keys)
    table = Table(segment_bits, n_tokens, n_types, n_texts, words[order], frequent.column("n").to_numpy()[order], keys[by_key], levels[by_key])
    model = Model(segments, segment_size, table)
    rare = segments.select("words", "word_counts").mapInArrow(_listed(0, 1 << least if least < 62 else None), "word bigint, n bigint")
    return model, rare


def _listed(least: int, below: int | None):
    """The words of segments with least <= count < below, one in a row."""

    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, raw_counts in zip(batch.column("words").to_pylist(), batch.column("word_counts").to_pylist()):
                word, n = np.frombuffer(raw, np.int64), np.frombuffer(raw_counts, np.int64)
                on = (n >= least) & (n < below) if below is not None else n >= least
                yield pa.RecordBatch.from_pydict({"word": pa.array(word[on]), "n": pa.array(n[on])})

    return run


def _joined(parts: list[pa.Array]) -> pa.Array:
    """Rows of several batches as a list of one row."""
    values = pa.concat_arrays(parts)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _chunks(most: int):
    """Rows packed into chunks of about ``most`` bytes of text, one in a row."""
    names = ["doc_id", "held_out", "text"]

    def flush(held: list[pa.RecordBatch], size: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[_joined([b.column(c) for b in held]) for c in names], pa.array([size], pa.int64())], names=[*names, "size"])

    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            _, offsets = utf8(batch.column("text"))
            for i, j in steps(offsets):
                held.append(batch.slice(i, j - i))
                size += int(offsets[j] - offsets[i])
                if size >= most:
                    yield flush(held, size)
                    held, size = [], 0
        if held:
            yield flush(held, size)

    return run


def _ask(shared, segment_bits: int):
    edges = np.arange(1, 1 << segment_bits, dtype=np.uint64) << np.uint64(64 - segment_bits)

    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, chunk in enumerate(batch.column("chunk").to_pylist()):
                token, before, _ = tokens(*utf8(batch.column("text")[r].values))
                keys, _, on = shared.value.asked(token, before)
                keys = keys[on]
                at = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
                some = np.flatnonzero(np.diff(at))
                ends = np.append(at[some], len(keys)) * _KEY_BYTES
                packed = pa.Array.from_buffers(pa.large_binary(), len(some), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(_pack(keys).tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), chunk)), pa.array(some.astype(np.int32)), packed.cast(pa.binary())], names=["chunk", "segment", "keys"])

    return run


def _answer(segment_bits: int, segment_size: int):
    def run(asking: pa.Table, held: pa.Table) -> pa.Table:
        levels = []
        if asking.num_rows:
            raw, segment = asking.column("keys").to_pylist(), asking.column("segment")[0].as_py()
            keys = _unpack(b"".join(raw), segment, segment_bits)
            found = _levels(np.frombuffer(held.column("bits")[0].as_py(), np.uint8), keys, segment_size) if held.num_rows else np.zeros(len(keys), np.uint8)
            at = np.append(0, np.cumsum([len(r) // _KEY_BYTES for r in raw]))
            levels = [found[i:j].tobytes() for i, j in zip(at[:-1], at[1:])]
        return pa.table({"chunk": asking.column("chunk"), "segment": asking.column("segment"), "levels": pa.array(levels, pa.binary())})

    return run


def _score(shared):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        model = shared.value
        logs = np.log10(model.counts + 1.0)
        rows = {c: chunk.column(c).combine_chunks().flatten() for c in ("doc_id", "held_out", "text")}
        n = len(rows["text"])
        token, before, at = tokens(*utf8(rows["text"]))
        keys, levels, on = model.asked(token, before)
        order = np.argsort(answers.column("segment").to_numpy())
        raw = answers.column("levels").to_pylist()
        levels[on] = np.frombuffer(b"".join(raw[i] for i in order), np.uint8)
        doc = np.repeat(np.arange(n), np.diff(at))
        word, where = np.unique(token, return_inverse=True)
        place = np.minimum(np.searchsorted(model.words, word), max(len(model.words) - 1, 0))
        known = model.words[place] == word if len(model.words) else np.zeros(len(word), bool)
        value = np.where(known, logs[place], 0.0) if len(logs) else np.zeros(len(word))
        rare = ~known[where]
        ends = np.append(0, np.cumsum(np.bincount(doc[rare], minlength=n))).astype(np.int32)
        return pa.table({
            "doc_id": rows["doc_id"], "held_out": rows["held_out"],
            "n_tokens": pa.array(np.diff(at)), "n_table": pa.array(np.bincount(doc[~rare], minlength=n)),
            "table_sum": pa.array(np.bincount(doc, weights=value[where], minlength=n)),
            "score": pa.array(np.bincount(doc, weights=model.log_probabilities(token, before, keys, levels), minlength=n)),
            "rare": pa.ListArray.from_arrays(ends, pa.array(token[rare].view(np.int64))),
        })

    return run


def score(docs: DataFrame, model: Model, rare: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of docs (doc_id, held_out, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model.table)
    kind = docs.schema["doc_id"].dataType.simpleString()
    chunks = docs.select("doc_id", "held_out", "text").mapInArrow(_chunks(CHUNK_BYTES), f"doc_id array<{kind}>, held_out array<boolean>, text array<string>, size bigint")
    chunks = materialize(chunks.withColumn("chunk", F.monotonically_increasing_id()), "bloom-chunks")
    # a segment answers in several groups where much more text asks than trained
    size = chunks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shares = -(-int(size) // (ASK_BYTES << model.segment_bits)) or 1
    asking = chunks.select("chunk", "text").mapInArrow(_ask(shared, model.segment_bits), "chunk bigint, segment int, keys binary")
    asking = asking.withColumn("share", F.pmod(F.xxhash64("chunk"), F.lit(shares)).cast("int"))
    held = model.segments.select("segment", "bits", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"))
    answers = asking.groupBy("segment", "share").cogroup(held.groupBy("segment", "share")).applyInArrow(
        _answer(model.segment_bits, model.segment_size), "chunk bigint, segment int, levels binary"
    )
    scored = chunks.drop("size").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _score(shared), f"doc_id {kind}, held_out boolean, n_tokens bigint, n_table bigint, table_sum double, score double, rare array<bigint>"
    )
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "bloom-scored")
    met = scored.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    found = met.join(rare, "word").groupBy("row").agg(F.sum("times").alias("n_rare"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("rare_sum"))
    base = F.col("table_sum") + F.coalesce("rare_sum", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(float(model.n_tokens + model.n_types + 1)))
    return scored.drop("rare").join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_table") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )


def held_out(divisor: int = 7, remainder: int = 2):
    return id_remainder("doc_id", divisor) == remainder
