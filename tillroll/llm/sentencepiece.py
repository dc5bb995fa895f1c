"""SentencePiece encoding and decoding by a batched numpy Viterbi search.

Words of equal length advance together, one character at a time: the hashes of
all substrings that end there probe the sorted hashes of the pieces, the
candidates' scores are compared with array maxima, and the winners' lengths are
the backpointers.

*Unigram models* maximise the sum of piece scores.  *BPE models* need the
segmentation that merging by score gives, which no sum of scores reproduces.
It is the one path whose neighbouring pieces are all compatible, that is, whose
two texts joined merge to just these two pieces; so a transition scores 0 if
the pair is compatible and minus infinity otherwise, and the same search finds
it.  Pairs are checked together by undoing both pieces' merges along the seam.

Words are cut where no piece can span: between two characters that are
neighbours in no piece.  This is exact for any model, keeps words short, and
lets equal words be encoded once; a worker keeps a bounded cache of them.
Characters outside the vocabulary become byte pieces or the unknown piece.

Defined cases: a null or empty text has no pieces and decodes to empty; texts
of any length are encoded whole; repeated rows are encoded each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.common import arrow_task, extended, groups, mix64, steps, utf8, without

SPACE = "▁"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Words a worker remembers, twice: two Python workers share an executor with its JVM.
CACHE = 250_000
#: Answers on pairs of pieces that a worker remembers, as a power of two.
MEMORY_BITS = 20
#: Leading bits of a piece's hash that tell where to look for it, as a power of two.
INDEX_BITS = 18
#: Bytes of text whose words are told apart and searched together.
STEP = 2 << 20
#: Longer words are cut further where no piece can span.
CUT_OVER = 24
_MUL = np.uint64(0xD6E8FEB86659FD93)
_NONE = -1
_LETTER = re.compile(r"[^\W\d_]")


class Vocabulary:
    """Pieces and scores of a SentencePiece model file, as arrays to probe."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str], unigram: bool, dummy_prefix: bool = True):
        self.pieces, self.unigram, self.dummy_prefix = pieces, unigram, dummy_prefix
        normal = [i for i, k in enumerate(kinds) if k == "normal" and pieces[i]]
        self.unknown = next((i for i, k in enumerate(kinds) if k == "unknown"), 0)
        self.byte_ids = {int(pieces[i][3:5], 16): i for i, k in enumerate(kinds) if k == "byte"}
        self.scores = np.asarray(scores, np.float64)
        text = {pieces[i]: i for i in normal}
        self.ids = text
        self.longest = max(map(len, text), default=1)
        self.ordered = True
        self.pairs_inside = {a + b for p in text for a, b in zip(p, p[1:])}
        self.bytes = [self._bytes(p, k) for p, k in zip(pieces, kinds)]
        self.memory_key, self.memory_ok = np.full(1 << MEMORY_BITS, -1), np.zeros(1 << MEMORY_BITS, bool)
        if not unigram:
            text = self._merges()
        hashes = np.array([self._hash(p) for p in text], np.uint64)
        order = np.argsort(hashes)
        # a last entry that no hash passes and no piece has
        self.sorted_hash = np.append(hashes[order], np.uint64(0xFFFFFFFFFFFFFFFF))
        self.sorted_id = np.append(np.fromiter(text.values(), np.int64, len(text))[order], _NONE)
        self.first_hash = np.searchsorted(self.sorted_hash, np.arange(1 << INDEX_BITS, dtype=np.uint64) << np.uint64(64 - INDEX_BITS)).astype(np.int32)
        # decoding: the bytes of all pieces in a row
        self.byte_length = np.array([len(b) for b in self.bytes], np.int64)
        self.byte_start = np.cumsum(self.byte_length) - self.byte_length
        self.byte_pool = np.frombuffer(b"".join(self.bytes) or b" ", np.uint8)

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for ch in text:
            h = ((h + ord(ch) + 1) * int(_MUL)) & 0xFFFFFFFFFFFFFFFF
        return h

    @staticmethod
    def _bytes(piece: str, kind: str) -> bytes:
        if kind == "byte":
            return bytes([int(piece[3:5], 16)])
        if kind == "unknown":
            return " ⁇ ".encode()
        return b"" if kind == "control" else piece.replace(SPACE, " ").encode()

    def _merges(self) -> dict[str, int]:
        """For every piece the two that its last merge joins, and the sorted pairs
        that merge: pairs are ranked by the joined piece's score, then from the left.
        Returns the pieces that merging can make at all.

        The search needs pieces that score no better than their parts, as trained
        models have; ``ordered`` tells, and words of others are merged plainly."""
        n = len(self.pieces)
        self.left, self.right = np.full(n, _NONE), np.full(n, _NONE)
        keys, joined = [], []
        for piece, i in self.ids.items():
            parts = self.merge_word(piece, whole=False)
            if len(parts) == 2:
                self.left[i], self.right[i] = parts
                # a part of one character is there from the start
                if any(self.scores[i] > self.scores[p] for p in parts if p >= 0 and len(self.pieces[p]) > 1):
                    self.ordered = False
            for k in range(1, len(piece)):
                a, b = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if a is not None and b is not None:
                    keys.append(a * n + b)
                    joined.append(i)
        order = np.argsort(keys) if keys else np.zeros(0, np.int64)
        self.pair_key, self.pair_piece = np.array(keys, np.int64)[order], np.array(joined, np.int64)[order]
        return {p: i for p, i in self.ids.items() if len(p) == 1 or self.left[i] != _NONE or self.right[i] != _NONE}

    def merge_word(self, word: str, whole: bool = True) -> list[int]:
        """Plain merging of one word; ``whole=False`` stops before all is one piece."""
        parts = list(word)
        while len(parts) > (1 if whole else 2):
            best = max(((self.scores[j], -k) for k in range(len(parts) - 1) if (j := self.ids.get(parts[k] + parts[k + 1])) is not None), default=None)
            if best is None:
                break
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self.ids.get(p, _NONE) for p in parts]

    # ------------------------------------------------------------- search

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of pieces by their hashes: from the first with a hash's leading bits
        on, as few have them."""
        at = self.first_hash[hashes >> np.uint64(64 - INDEX_BITS)]
        held = self.sorted_hash[at]
        found = held == hashes
        on = np.flatnonzero(held < hashes)
        while len(on):
            at[on] += 1
            held = self.sorted_hash[at[on]]
            found[on] = held == hashes[on]
            on = on[held < hashes[on]]
        out = np.full(len(hashes), _NONE)
        out[found] = self.sorted_id[at[found]]
        return out

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """``_compatible`` with a direct-mapped memory of the last answers."""
        key = first * len(self.pieces) + second
        key[(first < 0) | (second < 0)] = -2
        slot = (mix64(key.view(np.uint64)) >> np.uint64(64 - MEMORY_BITS)).astype(np.int64)
        miss = np.flatnonzero(self.memory_key[slot] != key)
        if len(miss):
            answer = self._compatible(first[miss], second[miss])
            out = self.memory_ok[slot]
            out[miss] = answer
            self.memory_key[slot[miss]], self.memory_ok[slot[miss]] = key[miss], answer
            # of two keys of a slot the last stays, with its own answer: both writes follow one order
            return out
        return self.memory_ok[slot]

    def _compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether merging the joined text of two pieces leaves just these two:
        undoing the later of both last merges again and again, no pair that meets
        at the seam may merge before what it would have had to wait for."""
        n, ok = len(self.pieces), np.ones(len(first), bool)
        live = np.flatnonzero((first >= 0) & (second >= 0))
        a, b = first[live], second[live]
        # when the piece on each side of the seam is used up by its own next merge; before the last: never
        until_a, until_b = np.full(len(live), -np.inf), np.full(len(live), -np.inf)
        while len(live):
            at = np.minimum(np.searchsorted(self.pair_key, a * n + b), max(len(self.pair_key) - 1, 0))
            meets = self.pair_key[at] == a * n + b if len(self.pair_key) else np.zeros(len(live), bool)
            score = np.where(meets, self.scores[self.pair_piece[at]], -np.inf) if len(self.pair_key) else np.full(len(live), -np.inf)
            # at equal score the merge further left is made first: the left side's own before the seam's, the seam's before the right side's
            bad = meets & (score > until_a) & (score >= until_b)
            ok[live[bad]] = False
            made_a = np.where(self.left[a] >= 0, self.scores[a], np.inf)
            made_b = np.where(self.left[b] >= 0, self.scores[b], np.inf)
            undo_b = (made_b <= made_a) & np.isfinite(made_b)
            undo_a = ~undo_b & np.isfinite(made_a)
            until_a = np.where(undo_a, made_a, until_a)
            until_b = np.where(undo_b, made_b, until_b)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_b, self.left[b], b)
            on = (undo_a | undo_b) & ~bad
            live, a, b, until_a, until_b = live[on], a[on], b[on], until_a[on], until_b[on]
        return ok

    def _advance(self, words: list[str]) -> list[bytes]:
        """Best paths of words of one length, each as packed 32-bit ids."""
        n, size = len(words), len(words[0])
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, size).astype(np.uint64) + np.uint64(1)
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0
        length, piece = np.zeros((n, size + 1), np.int32), np.full((n, size + 1), _NONE)
        reach = min(self.longest, size)
        # substring hashes by start, grown by one character each step of `span`
        table = np.full((reach, n, size), _NONE)
        h = np.zeros((n, size), np.uint64)
        for span in range(reach):
            h = (h[:, : size - span] + code[:, span:]) * _MUL
            table[span, :, : size - span] = self.lookup(h.ravel()).reshape(h.shape)
        floor = self.scores.min() - 10.0
        row = np.arange(n)
        for end in range(1, size + 1):
            spans = np.arange(1, min(reach, end) + 1)
            starts = end - spans
            ids = table[spans - 1, :, starts].T  # word x candidate
            if self.unigram:
                gain = np.where(ids >= 0, self.scores[np.maximum(ids, 0)], -np.inf)
                gain[:, 0] = np.where(ids[:, 0] >= 0, gain[:, 0], floor)
            else:
                # of the candidates compatible with the path before them the longest counts
                fits = ids >= 0
                fits[:, 0] = True  # a lone character stands, known or not
                asked = fits.copy()
                if starts[-1] == 0:  # the longest has nothing before it, where it fits nothing is asked
                    asked[:, :-1] &= ~fits[:, -1:]
                    asked[:, -1] = False
                w, c = np.nonzero(asked)
                fits[w, c] = self.compatible(piece[w, starts[c]], ids[w, c])
                longest = fits.shape[1] - 1 - fits[:, ::-1].argmax(axis=1)
                gain = np.full(ids.shape, -np.inf)
                gain[row, longest] = np.where(fits[row, longest], 0.0, -np.inf)
            total = best[:, starts] + gain
            pick = total.argmax(axis=1)
            best[:, end], length[:, end], piece[:, end] = total[row, pick], spans[pick], ids[row, pick]
        # follow the backpointers of all words at once
        at, count, path, ends = np.full(n, size), np.zeros(n, np.int64), [], []
        while at.any():
            path.append(np.where(at > 0, piece[row, at], _NONE))
            ends.append(at)
            count += at > 0
            at = np.where(at > 0, at - length[row, at], 0)
        path, ends = np.stack(path[::-1], axis=1).astype(np.int32), np.stack(ends[::-1], axis=1)
        used = np.arange(path.shape[1]) >= path.shape[1] - count[:, None]
        raw, stop = path[used].tobytes(), np.cumsum(count * 4).tolist()
        out = [raw[lo:hi] for lo, hi in zip([0, *stop], stop)]
        for k in np.flatnonzero((used & (path < 0)).any(axis=1)).tolist():
            own, stops = path[k, used[k]].tolist(), [0, *ends[k, used[k]].tolist()]
            ids = [x for i, lo, hi in zip(own, stops, stops[1:]) for x in ([i] if i >= 0 else self._unknown(words[k][lo:hi]))]
            out[k] = np.array(ids, np.int32).tobytes()
        return out

    def _plain(self, word: str) -> bytes:
        ids, at = [], 0
        for i in self.merge_word(word):
            size = len(self.pieces[i]) if i >= 0 else 1
            ids.extend([i] if i >= 0 else self._unknown(word[at : at + size]))
            at += size
        return np.array(ids, np.int32).tobytes()

    def _unknown(self, text: str) -> list[int]:
        raw = text.encode("utf-8", "surrogatepass")
        return [self.byte_ids[b] for b in raw] if len(self.byte_ids) == 256 else [self.unknown]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Encodings of cut words, those of a length together, in blocks of bounded
        size; packed 32-bit ids."""
        if not (self.unigram or self.ordered):
            return [self._plain(w) for w in words]
        out: list = [None] * len(words)
        order, starts, count = groups(np.fromiter(map(len, words), np.int64, len(words)))
        for lo, n in zip(starts.tolist(), count.tolist()):
            size = len(words[order[lo]])
            most = max(1, 200_000 // (size * min(size, self.longest)))
            for i in range(lo, lo + n, most):
                block = order[i : min(i + most, lo + n)].tolist()
                for k, ids in zip(block, self._advance([words[k] for k in block])):
                    out[k] = ids
        return out

    def cut(self, text: str) -> list[str]:
        """Words between which no piece can span."""
        inside, out, start = self.pairs_inside, [], 0
        for k in range(1, len(text)):
            if text[k - 1 : k + 1] not in inside:
                out.append(text[start:k])
                start = k
        if text:
            out.append(text[start:])
        return out


class Encoder:
    """Encodes and decodes texts; a word met again is not searched again."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        #: words met lately, and those met before the last full ``recent``
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.split = self._splitter(vocabulary.pairs_inside)

    @staticmethod
    def _splitter(pairs: set[str]) -> re.Pattern | None:
        """Where texts can be split before any search, as no piece spans it: before
        spaces, between a letter and a mark that follows none in a piece, and around
        marks that are in no piece with others."""
        if any(b == SPACE and a != SPACE for a, b in pairs):
            return None
        ascii_ = [chr(i) for i in range(128) if not chr(i).isalnum() and chr(i) != " "]
        alone = "".join(c for c in ascii_ if not any(c in p for p in pairs))
        after_letter = {b for a, b in pairs if _LETTER.match(a)}
        ends = "".join(c for c in ascii_ if c not in alone and c not in after_letter)
        alone, ends = re.escape(alone), re.escape(ends)
        one = rf"[{alone}]|" if alone else ""
        more = rf"(?:[^ {alone}{ends}]|(?<![^\W\d_])[{ends}])" if ends else rf"[^ {alone}]"
        return re.compile(rf"{one} *[^ {alone}]{more}*| +")

    def words(self, text: str) -> list[str]:
        """A run of spaces belongs to the word after it.  Spaces stand for the space
        character of pieces, which would double the bytes of most words."""
        if not text:
            return []
        text = text.replace(SPACE, " ")
        if self.v.dummy_prefix:
            text = " " + text
        return self.split.findall(text) if self.split else [text]

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        known, older, recent = {}, self.older, self.recent
        searched = []
        for w in words:
            if w in recent:
                continue
            if w in older:
                known[w] = older[w]
            else:
                searched.append(w)
        whole = [w for w in searched if len(w) <= CUT_OVER]
        parts = {w: self.v.cut(w.replace(" ", SPACE)) for w in searched if len(w) > CUT_OVER}
        distinct = list({x for ws in parts.values() for x in ws})
        codes = self.v.encode_words([w.replace(" ", SPACE) for w in whole] + distinct)
        known.update(zip(whole, codes))
        found = dict(zip(distinct, codes[len(whole) :]))
        for w, ws in parts.items():
            known[w] = b"".join([found[x] for x in ws])
        if len(self.recent) + len(known) > CACHE:
            # what this batch needs stays, the rest may be forgotten with the next turn
            kept = {w: self.recent[w] for w in words - known.keys()}
            self.older, self.recent = self.recent, kept
        self.recent.update(known)
        return self.recent

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts in a row, and the n+1 offsets of the texts."""
        split = [self.words(t) for t in texts]
        code = self._learn(set().union(*split)).__getitem__
        got = [b"".join(map(code, s)) for s in split]
        return np.frombuffer(b"".join(got), np.int32), np.append(0, np.cumsum([len(x) // 4 for x in got], dtype=np.int64))

    def decode_batch(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of all texts in a row, and the n+1 offsets of the texts."""
        v = self.v
        size = v.byte_length[flat]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        data = v.byte_pool[np.repeat(v.byte_start[flat] - (ends - size), size) + np.arange(total)]
        bounds = np.append(0, ends)[offsets]
        if v.dummy_prefix and total:
            first = bounds[:-1][np.diff(bounds) > 0]
            first = first[data[first] == 32]
            drop = np.zeros(total + 1, np.int64)
            drop[first + 1] = 1
            bounds = bounds - np.cumsum(drop)[bounds]
            data = np.delete(data, first)
        return data, bounds

    def decode(self, ids: list[int]) -> str:
        data, _ = self.decode_batch(np.asarray(ids, np.int32), np.array([0, len(ids)]))
        return data.tobytes().decode("utf-8", "replace")


def load(path: str = DEFAULT_MODEL) -> Vocabulary:
    """Read a model file; the library is used for the file format only."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    kinds = [
        "byte" if sp.is_byte(i) else "unknown" if sp.is_unknown(i) else "control" if sp.is_control(i) else "unused" if sp.is_unused(i) else "normal"
        for i in range(n)
    ]
    pieces = [sp.id_to_piece(i) for i in range(n)]
    # trainer_spec.model_type (field 2, number 3 within): 1 unigram, 2 BPE
    kind = _field(_field(sp.serialized_model_proto(), 2, b""), 3, 1)
    normalizer = _field(sp.serialized_model_proto(), 3, b"")
    if _field(normalizer, 2, b"") or _field(normalizer, 4, 1):
        raise ValueError("only models without character normalisation are supported")
    if kind not in (1, 2):
        raise ValueError("only unigram and BPE models are supported")
    return Vocabulary(pieces, [sp.get_score(i) for i in range(n)], kinds, unigram=kind == 1, dummy_prefix=bool(_field(normalizer, 3, 1)))


def _field(message: bytes, number: int, default):
    """Last value of a field of a protocol-buffer message."""
    at, value = 0, default

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = message[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            got = varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            got = message[at : at + size]
            at += size
        if key >> 3 == number:
            value = got
    return value


_encoders: dict[str, Encoder] = {}


def encoder(path: str = DEFAULT_MODEL) -> Encoder:
    """One encoder for each model and worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(load(path))
    return _encoders[path]


def _encode(path: str, column: str):
    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            text = batch.column(column)
            data, offsets = utf8(text)
            for i, j in steps(offsets, STEP):
                flat, at = enc.encode_batch([t or "" for t in text[i:j].to_pylist()])
                back, bounds = enc.decode_batch(flat, at)
                raw = data[offsets[i] : offsets[j]]
                same = [
                    bool(np.array_equal(raw[lo - offsets[i] : hi - offsets[i]], back[x:y]))
                    for lo, hi, x, y in zip(offsets[i:j], offsets[i + 1 : j + 1], bounds, bounds[1:])
                ]
                listed = pa.ListArray.from_arrays(at.astype(np.int32), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(i, j - i).columns, listed, pa.array(np.diff(at)), pa.array(same, pa.bool_())],
                    names=[*batch.schema.names, "piece_ids", "n_pieces", "round_trip"],
                )

    return run


def encode(docs: DataFrame, path: str = DEFAULT_MODEL, column: str = "text") -> DataFrame:
    """All columns of docs with piece_ids, n_pieces, and round_trip: whether
    decoding the pieces gives the text back (null as empty); columns of these names
    are replaced.  The space character of pieces (U+2581) in a text decodes to a
    space, as in the library."""
    docs = without(docs, "piece_ids", "n_pieces", "round_trip")
    return docs.mapInArrow(_encode(path, column), extended(docs, "piece_ids array<int>, n_pieces bigint, round_trip boolean"))


def _decode(path: str, column: str):
    @arrow_task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            decoded = pa.array([enc.decode(x or []) for x in batch.column(column).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], names=[*batch.schema.names, "decoded"])

    return run


def decode(pieces: DataFrame, path: str = DEFAULT_MODEL, column: str = "piece_ids") -> DataFrame:
    """All columns with ``decoded``, the text of the piece ids."""
    pieces = without(pieces, "decoded")
    return pieces.mapInArrow(_decode(path, column), extended(pieces, "decoded string"))
