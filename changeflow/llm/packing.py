"""Best-fit packing of tokenised documents by linear grouping.

Only the count of pieces per length reaches the driver: at most `capacity` numbers, whatever
the size of the corpus.  From it the driver makes a plan of runs - "the pieces of length l
with ranks r to r+n-1 go to sequences s to s+n-1 at offset o" - whose number depends on the
number of lengths and not on the number of pieces.  Tasks then rank pieces within their
length and look their run up.

The plan follows the linear grouping scheme.  Large lengths are put in descending order, cut
into groups of equal cardinality and rounded up to the largest of their group.  For these few
sizes a linear programme over configurations (what fits into one sequence) is solved by column
generation, and its solution rounded down.  Actual pieces take the places of the rounded ones.
What is left over and all small pieces then go where they fit best.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import parts, stored, type_of

CAPACITY = 2048
SEPARATOR = 0
#: Groups of equal cardinality, and the parts of the capacity up to which a piece may count as small.
GROUPS, SMALL = 128, (0.45, 0.3)
#: Steps of the linear programme without gain after which it stops.
STEPS = 40
#: Text that is encoded in one call.
BATCH_BYTES = 8_000_000
#: Pieces that are ranked together.
RANKED = 20_000
#: The only special token of the vocabulary.
SPECIAL = "<|endoftext|>"


# ---------------------------------------------------------------- tokens


class Encoder:
    """Ids of many texts by the byte-level vocabulary, each text followed by the separator.

    Texts are cut before every space.  No token of the vocabulary's pattern spans the place
    between anything else and a space, so each word with its space is encoded once per call,
    all in one string, and its ids are put wherever it stands.  Texts where that doesn't hold
    (white space before a space, special tokens) are encoded whole.
    """

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.special = np.array([len(ranks)], np.uint32)
        self.spaced = np.zeros(len(ranks), bool)
        self.spaced[[rank for token, rank in ranks.items() if token[:1] == b" "]] = True
        self.coding = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.plain = self.coding.encode_ordinary

    def whole(self, text: str) -> np.ndarray:
        found = [np.array(self.plain(part), np.uint32) for part in text.split(SPECIAL)]
        return np.concatenate([x for part in found for x in (self.special, part)][1:])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids begin and the last ends."""
        texts = pc.fill_null(texts, "")
        words = pc.split_pattern(texts, " ")
        ends = words.offsets.to_numpy() - words.offsets[0].as_py()
        distinct = words.flatten().dictionary_encode()
        used = distinct.indices.to_numpy().astype(np.int64)
        known = distinct.dictionary
        odd_words = pc.match_substring_regex(known, _UNSURE)
        unsure = odd_words.to_numpy(zero_copy_only=False)
        listed = pa.ListArray.from_arrays([0, len(known)], pc.if_else(odd_words, "x", known))
        text = " " + pc.binary_join(listed, " ")[0].as_py() if len(known) else ""
        joined = self.coding.encode_to_numpy(text, disallowed_special=())
        begin = np.flatnonzero(self.spaced[joined]) if len(joined) else np.zeros(0, np.int64)
        if len(begin) != len(known):
            raise ValueError("a word's ids don't begin at its space")

        # The first word of a text has no space before it, unsure texts are one word each, the separator is another.
        count = len(texts)
        odd = np.logical_or.reduceat(unsure[used], ends[:-1]) if count else np.zeros(0, bool)
        first = [
            self.whole(texts[i].as_py()) if odd[i] else np.array(self.plain(known[used[ends[i]]].as_py()), np.uint32)
            for i in range(count)
        ]
        pool = np.concatenate([joined, *first, np.array([SEPARATOR], np.uint32)])
        lengths = np.concatenate([np.diff([*begin, len(joined)]), [len(x) for x in first], [1]]).astype(np.int64)
        begins = np.cumsum(lengths) - lengths
        shown = np.ones(len(used), bool)
        shown[np.repeat(odd, np.diff(ends))] = False
        shown[ends[:-1]] = True
        used[ends[:-1]] = len(known) + np.arange(count)
        used, shown = np.insert(used, ends[1:], len(known) + count), np.insert(shown, ends[1:], True)
        size = np.where(shown, lengths[used], 0)
        stop = np.cumsum(size)
        ids = pool[np.repeat(begins[used] - (stop - size), size) + np.arange(int(stop[-1]) if count else 0)]
        return ids, np.concatenate([[0], stop[ends[1:] + np.arange(count)]]) if count else np.zeros(1, np.int64)


#: Words whose texts are encoded whole, as the place after them may not be a token's end: none, white space
#: at the end, a control character that only some libraries take for white space, a special token.
_UNSURE = r"^$|[\x09-\x0d\x1c-\x1f\x{85}\pZ]$|[\x1c-\x1f]|<\|endoftext\|>"
_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k",
    capacity: int = CAPACITY,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each document's ids and the separator.

    A document of at most `capacity` ids is one piece.  A longer one is cut into pieces of
    exactly `capacity`, after a first piece that takes the remainder.  Null and empty texts
    have the separator only; repeated rows give repeated pieces; other columns are not read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in (part for whole in batches for part in parts(whole, 1, BATCH_BYTES)):
            ids, ends = encode(batch.column(1))
            total = np.diff(ends)
            first = np.where(total % capacity, total % capacity, capacity)
            each = (total - first) // capacity + 1
            row = np.repeat(np.arange(len(total)), each)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
            start = np.where(piece, first[row] + (piece - 1) * capacity, 0)
            length = np.where(piece, capacity, first[row])
            data = memoryview(ids.astype("<u4").tobytes())
            at = 4 * (ends[row] + start)
            crc = [zlib.crc32(data[lo:hi]) for lo, hi in zip(at.tolist(), (at + 4 * length).tolist())]
            columns = [piece.astype(np.int32), start, length, np.array(crc, np.int64)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *map(pa.array, columns)], names=_PIECE)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        cut, f"doc_id {type_of(docs, id_col)}, piece int, start long, length long, ids_crc32 long"
    )


_PIECE = ["doc_id", "piece", "start", "length", "ids_crc32"]


# ---------------------------------------------------------------- plan


class Plan:
    """Runs, and the room left in sequences as ranges of sequence numbers by free tokens."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = [0] * (capacity + 1)
        for length, n in counts.items():
            self.left[length] = n
        self.rank = [0] * (capacity + 1)
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.room: list[deque] = [deque() for _ in range(capacity + 1)]
        self.free = 0  # bit r is set if some sequence has r free tokens

    def put(self, length: int, n: int, sequence: int, free: int) -> int:
        """n pieces of one length into as many sequences; gives the tokens that stay free."""
        self.runs.append((length, self.rank[length], n, sequence, self.capacity - free))
        self.rank[length] += n
        self.left[length] -= n
        return free - length

    def open(self, lengths: list[int], n: int) -> None:
        """n new sequences that each hold pieces of these lengths."""
        free = self.capacity
        for length in lengths:
            free = self.put(length, n, self.sequences, free)
        self.spare(self.sequences, n, free)
        self.sequences += n

    def spare(self, sequence: int, n: int, free: int) -> None:
        if free:
            self.room[free].append((sequence, n))
            self.free |= 1 << free

    def best_fit(self, length: int) -> None:
        """All pieces of a length that are left go to the fullest sequences that take them."""
        while n := self.left[length]:
            if fits := self.free >> length:
                free = length + (fits & -fits).bit_length() - 1
                sequence, have = self.room[free].popleft()
                if n < have:
                    self.room[free].appendleft((sequence + n, have - n))
                elif not self.room[free]:
                    self.free &= ~(1 << free)
                n = min(n, have)
                self.spare(sequence, n, self.put(length, n, sequence, free))
            elif each := n // (self.capacity // length):
                self.open([length] * (self.capacity // length), each)
            else:
                self.open([length] * n, 1)


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small: tuple = SMALL) -> Plan:
    """The runs that pack so many pieces of each length (1 to capacity); of all `small` the one with fewest sequences."""
    return min((_plan(counts, capacity, groups, part) for part in small), key=lambda made: made.sequences)


def _plan(counts: dict[int, int], capacity: int, groups: int, small: float) -> Plan:
    made = Plan(counts, capacity)
    if made.left[capacity]:
        made.open([capacity], made.left[capacity])
    sizes, members = _grouped(made.left, capacity, groups, math.floor(capacity * small))
    if sizes:
        demand = [sum(n for _, n in group) for group in members]
        for configuration, copies in configurations(np.array(sizes), np.array(demand, float), capacity):
            _substitute(made, configuration, copies, members)
    for length in range(capacity, 0, -1):
        made.best_fit(length)
    return made


def _grouped(left: list[int], capacity: int, groups: int, small: int) -> tuple[list[int], list[deque]]:
    """Large lengths in descending groups of equal cardinality: rounded size, and (length, count) of the members."""
    total = sum(left[small + 1 : capacity])
    sizes: list[int] = []
    members: list[deque] = []
    done = 0
    for length in range(capacity - 1, small, -1):
        n = left[length]
        while n:
            group = done * groups // total
            last = -(-(group + 1) * total // groups)  # the first place that is no more in this group
            take = min(n, last - done)
            if sizes and (members[-1][0][0] == length or done > (-(-group * total // groups))):
                members[-1].append((length, take))
            else:
                sizes.append(length)
                members.append(deque([(length, take)]))
            done += take
            n -= take
    return sizes, members


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Counts per size that fit into one sequence, and how often to use each, rounded down.

    Revised simplex on "every size as often as demanded, in as few sequences as possible".
    The column that enters is the best-valued configuration, found by dynamic programming.
    Any basis is feasible, so stopping after a number of steps without gain is safe.
    """
    basis = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1 / np.diag(basis))
    least, steps = np.inf, 0
    while steps < STEPS:
        amount = (inverse * demand).sum(axis=1)
        steps = 0 if amount.sum() < least * (1 - 1e-6) else steps + 1
        least = min(least, amount.sum())
        column, value = _best_configuration(sizes, inverse.sum(axis=0), capacity)
        if value <= 1 + 1e-9:
            break
        step = (inverse * column).sum(axis=1)
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        leaves = int(ratio.argmin())
        basis[:, leaves] = column
        inverse[leaves] /= step[leaves]
        step[leaves] = 0
        inverse -= step[:, None] * inverse[leaves]
    return [(basis[:, j].astype(int), max(0, math.floor(x + 1e-9))) for j, x in enumerate((inverse * demand).sum(axis=1))]


def _best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The configuration of largest value: item after item, for every used capacity at once."""
    from_ = np.arange(capacity + 1)[None, :] - sizes[:, None]
    allowed = from_ >= 0
    from_[~allowed] = 0
    best, chosen = np.zeros(capacity + 1), []
    for _ in range(capacity // int(sizes.min())):
        worth = np.where(allowed, best[from_] + values[:, None], -np.inf)
        item = worth.argmax(axis=0)
        more = worth[item, np.arange(capacity + 1)]
        chosen.append(np.where(more > best + 1e-12, item, -1))
        if (chosen[-1] < 0).all():
            break
        best = np.maximum(best, more)
    column, at = np.zeros(len(sizes)), capacity
    for item in reversed(chosen):
        if item[at] >= 0:
            column[item[at]] += 1
            at -= sizes[item[at]]
    return column, float((values * column).sum())


def _substitute(made: Plan, configuration: np.ndarray, copies: int, members: list[deque]) -> None:
    """Actual pieces take the places of the rounded sizes, as many sequences at a time as have equal lengths."""
    places = [group for group, n in enumerate(configuration) for _ in range(n)]
    while copies and places:
        asked = {group: places.count(group) for group in places}
        if any(sum(n for _, n in members[group]) < k for group, k in asked.items()):
            return  # what a rounding error asks too much is left to the best fit
        taken, n = [], copies
        for group, k in asked.items():
            for length, have in members[group]:
                take = min(k, have)
                taken.append((group, length, take))
                n = min(n, have // take)
                k -= take
                if not k:
                    break
        for group, length, k in taken:
            _take(members[group], length, k * n)
        made.open([length for _, length, k in taken for _ in range(k)], n)
        copies -= n


def _take(group: deque, length: int, n: int) -> None:
    for i, (x, have) in enumerate(group):
        if x == length:
            if have > n:
                group[i] = (x, have - n)
            else:
                del group[i]
            return


# ---------------------------------------------------------------- operator


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """cut(doc_id, piece, length, ...) with sequence_id and offset; offsets of a sequence leave no gap.

    Lengths are 1 to capacity.  Equal rows (repeated documents) are packed one by one.  Pieces of
    one length are ranked by bucket of their id, so that a length that many share is ranked in
    many tasks.  No pieces give no rows.
    """
    cut = stored(cut, "pieces")
    counts = {length: n for length, n in cut.groupBy("length").count().collect()}
    made = plan(counts, capacity)
    # One run per row: length, first rank, pieces, first sequence, offset; sorted for a search.
    runs = np.array(sorted(made.runs), np.int64).reshape(-1, 5)
    shared = cut.sparkSession.sparkContext.broadcast((runs[:, 0] << 44 | runs[:, 1], runs))

    buckets = max(64, -(-sum(counts.values()) // RANKED))
    dealt = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = (
        dealt.groupBy("length", "_bucket")
        .count()
        .select(
            "length",
            "_bucket",
            (F.sum("count").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("count")).alias("_before"),
        )
    )
    within = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        dealt.withColumn("_rank", F.row_number().over(within))
        .join(before, ["length", "_bucket"])
        .withColumn("_rank", F.col("_rank") + F.col("_before") - 1)
        .select(*cut.columns, "_rank")
    )

    names = [*cut.columns, "sequence_id", "offset"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, runs = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            run = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            sequence = runs[run, 3] + rank - runs[run, 1]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(runs[run, 4])], names=names
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(look_up, f"{kinds}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k",
    capacity: int = CAPACITY,
) -> DataFrame:
    """Pieces of all documents and their places in as few sequences of `capacity` tokens as it can."""
    return pack(pieces(docs, id_col, text_col, vocabulary, capacity), capacity)
