"""Language-model scoring by context-tree weighting (Willems, Shtarkov, Tjalkens 1995).

Every byte is eight binary decisions, most significant first. A decision is predicted in the
contexts of the last 0, 1, ... ``DEPTH`` bytes together with the bits of the byte known so far; each
context has a Krichevsky-Trofimov estimate (n1 + 1/2) / (n + 1) from the counts of the training
texts. A node's weighted probability is half its own estimate's and half the product of its
children's, and the posterior shares along a path of contexts mix the estimates of all
depths. Texts begin in the context of zero bytes and end with a zero byte, so the code lengths
of different texts compare.

Every context that the training texts hold is a node of the tree; none is pruned. No task and no machine
holds the tree or the vocabulary:

* Texts are dealt into blocks of about ``BLOCK`` bytes, each from one partition. A block asks once for each of its tokens and once
  for each of its grams (a context of ``DEPTH`` bytes and the byte after it), with their training counts.
* Grams are grouped by the last ``TOP`` bytes of their contexts, their root. Below a root there are at most
  256^2 contexts, whatever the corpus. Weighted values are computed from the deepest contexts up to the
  root, those of the roots are summed by context of ``TOP`` - 1 bytes, and the contexts above the roots (at
  most 65,793) are weighted on the driver and broadcast.
* A second pass over the roots mixes the estimates and gives every block the code lengths of its grams.
* A block then scores its texts by its own grams and tokens. Tokens are counted over all blocks alike.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartpulse.llm import common
from cartpulse.session import stored

DEPTH = 5
TOP = 3
BLOCK = 32 << 20
FOLDS, HELD_OUT = 7, 2
END = b"\n"  # the end token; no word holds white space
_FLUSH = 1 << 19  # tokens a task holds before it passes their counts on
_CHUNK = 1 << 22  # bytes sorted at a time
_ASKED = 1 << 20  # grams priced at a time


def followed(text: bytes) -> np.ndarray:
    """For every byte of the text and its end: its context and the byte, as one number. From the highest: the root, the
    latest byte lowest; the fourth and the fifth byte back; the byte."""
    padded = np.frombuffer(b"\0" * DEPTH + text + b"\0", np.uint8)
    found = np.zeros(len(text) + 1, np.int64)
    for back in (*range(TOP, 0, -1), *range(TOP + 1, DEPTH + 1), 0):
        found = found << 8 | padded[DEPTH - back : DEPTH - back + len(found)]
    return found


def tokens_of(text: bytes) -> list[bytes]:
    return [*common.words_of(text.lower()), END]


def _merged(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and the sums of their counts."""
    found, at = np.unique(values, return_inverse=True)
    return found, np.bincount(at, counts, len(found)).astype(np.int64)


class _Grams:
    """Sorted distinct numbers with their counts in training texts."""

    def __init__(self):
        self.waiting, self.size = {True: [], False: []}, 0
        self.values, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, values: np.ndarray, train: bool) -> None:
        self.waiting[train].append(values)
        self.size += len(values)
        if self.size >= _CHUNK:
            self.sum()

    def sum(self) -> None:
        new, n = np.unique(np.concatenate([np.zeros(0, np.int64), *self.waiting[True]]), return_counts=True)
        other = np.unique(np.concatenate([np.zeros(0, np.int64), *self.waiting[False]]))
        self.waiting, self.size = {True: [], False: []}, 0
        values = np.concatenate([self.values, new, other])
        self.values, self.counts = _merged(values, np.concatenate([self.counts, n, np.zeros(len(other))]))

    def taken(self):
        out = self.values, self.counts
        self.values, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        return out


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _by_root(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the roots of sorted grams begin, and how many grams each has."""
    starts = np.flatnonzero(np.diff(grams >> 24, prepend=-1))
    return starts, np.diff(starts, append=len(grams))


_DEALT = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.binary()), ("block", pa.int64())]
)
_DEALT_SPARK = "doc_id long, held_out boolean, text binary, block long"


def _dealt(batches):
    size = 0
    for rows in batches:
        block = pc.add(rows.column("part").cast(pa.int64()), pa.scalar((size // BLOCK) << 32))
        yield common.batch(_DEALT, [*rows.columns[:3], block])
        size += rows.nbytes


_INTS = pa.list_(pa.int32())
_ASKS = pa.schema(
    [("block", pa.int64()), ("token", pa.binary()), ("n", pa.int64()), ("root", pa.int32()), ("grams", _INTS), ("counts", _INTS)]
)
_ASKS_SPARK = "block long, token binary, n long, root int, grams array<int>, counts array<int>"


def _asked(batches):
    tokens: Counter = Counter()
    grams = _Grams()

    def of_tokens(block):
        keys, n = list(tokens), list(tokens.values())
        tokens.clear()
        none = pa.nulls(len(n), pa.int32())
        lists = pa.nulls(len(n), _INTS)
        return common.batch(_ASKS, [pa.array([block] * len(n), pa.int64()), keys, n, none, lists, lists])

    def of_grams(block):
        values, n = grams.taken()
        starts, sizes = _by_root(values)
        columns = [
            pa.array([block] * len(sizes), pa.int64()), pa.nulls(len(sizes), pa.binary()), pa.nulls(len(sizes), pa.int64()),
            (values[starts] >> 24).astype(np.int32), _lists((values & 0xFFFFFF).astype(np.int32), sizes),
            _lists(n.astype(np.int32), sizes),
        ]
        rows = common.batch(_ASKS, columns)
        yield from (rows.slice(at, common.BATCH_ROWS) for at in range(0, len(rows), common.BATCH_ROWS))

    block = None
    for rows in batches:
        for of, train, text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            if of != block and block is not None:
                grams.sum()
                yield of_tokens(block)
                yield from of_grams(block)
            block = of
            words = tokens_of(text)
            if train:
                tokens.update(words)
            else:
                for word in words:
                    tokens.setdefault(word, 0)
            grams.add(followed(text), train)
            if len(tokens) >= _FLUSH:
                yield of_tokens(block)
            if len(grams.values) >= _FLUSH * 4:
                yield from of_grams(block)
    if block is not None:
        grams.sum()
        yield of_tokens(block)
        yield from of_grams(block)


def _flat(rows: pa.RecordBatch, name: str) -> np.ndarray:
    return rows.column(name).flatten().to_numpy(zero_copy_only=False)


def _grams_of(rows: pa.RecordBatch) -> np.ndarray:
    """Whole grams of rows (root, grams), one after another."""
    roots = rows.column("root").to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(rows.column("grams").offsets.to_numpy())
    return np.repeat(roots, sizes) << 24 | _flat(rows, "grams")


class _Level:
    """Counts of one binary decision below the contexts of one depth: of sorted distinct (context, byte) with
    counts, grouped by context and the bits before it."""

    def __init__(self, follows: np.ndarray, n: np.ndarray, bit: int):
        group = follows >> (8 - bit)
        self.first = np.flatnonzero(np.diff(group, prepend=-1))
        self.at = np.cumsum(np.diff(group, prepend=-1) != 0) - 1
        self.ones = np.bincount(self.at, n * (follows >> (7 - bit) & 1), len(self.first))
        self.all = np.bincount(self.at, n, len(self.first))
        self.own = _kt(self.all - self.ones, self.ones)
        self.estimate = (self.ones + 0.5) / (self.all + 1)

    def mixed(self, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weighted log probability and the share of the own estimate, given that of all longer contexts."""
        weighted = np.logaddexp(self.own, below) - np.log(2)
        return weighted, np.exp(self.own - np.log(2) - weighted)


def subtrees(grams: np.ndarray, n: np.ndarray):
    """Of sorted distinct grams with training counts, yields for each of the eight decisions of their bytes:
    the probability of a one given the root and longer contexts, by gram; and the first gram and the
    weighted log probability of every (root, bits before)."""
    byte = grams & 255
    fours, at_four, of_four = np.unique(grams >> 16 << 8 | byte, return_index=True, return_inverse=True)
    threes, at_three, of_three = np.unique(grams >> 24 << 8 | byte, return_index=True, return_inverse=True)
    n_fours = np.bincount(of_four, n, len(fours))
    n_threes = np.bincount(of_three, n, len(threes))
    for bit in range(8):
        five, four, three = (_Level(*x, bit) for x in ((grams, n), (fours, n_fours), (threes, n_threes)))
        up_four = four.at[of_four[five.first]]
        weighted, stop_four = four.mixed(np.bincount(up_four, five.own, len(four.first)))
        up_three = three.at[of_three[at_four[four.first]]]
        weighted, stop_three = three.mixed(np.bincount(up_three, weighted, len(three.first)))
        one = stop_four[up_four] * four.estimate[up_four] + (1 - stop_four[up_four]) * five.estimate
        of_root = up_three[up_four]
        one = stop_three[of_root] * three.estimate[of_root] + (1 - stop_three[of_root]) * one
        yield one[five.at], at_three[three.first], weighted


_TRAINED = pa.schema(
    [("root", pa.int32()), ("grams", _INTS), ("counts", pa.list_(pa.int64())), ("nodes", _INTS), ("logs", pa.list_(pa.float64())),
     ("bytes", _INTS), ("times", pa.list_(pa.int64()))]
)
_TRAINED_SPARK = (
    "root int, grams array<int>, counts array<long>, nodes array<int>, logs array<double>, bytes array<int>, "
    "times array<long>"
)


def _trained(batches):
    """Of rows (root, grams, counts) by root: all grams of each root, with the weighted log probabilities of its
    nodes (2^d - 1 + p for the prefix p of d bits) and the counts of the bytes that follow it."""
    values, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting, size = [], 0

    def merged():
        return _merged(
            np.concatenate([values, *(v for v, _ in waiting)]), np.concatenate([counts, *(n for _, n in waiting)])
        )

    def weighed(values, counts):
        starts, sizes = _by_root(values)
        roots = values[starts] >> 24
        of, nodes, logs = [], [], []
        for bit, (_, first, weighted) in enumerate(subtrees(values, counts)):
            of.append(values[first] >> 24)
            nodes.append((1 << bit) - 1 + ((values[first] & 255) >> (8 - bit)))
            logs.append(weighted)
        of, nodes, logs = map(np.concatenate, (of, nodes, logs))
        order = np.argsort(of, kind="stable")
        follows, times = _merged(values >> 24 << 8 | values & 255, counts)
        rows = common.batch(
            _TRAINED,
            [roots.astype(np.int32), _lists((values & 0xFFFFFF).astype(np.int32), sizes), _lists(counts, sizes),
             _lists(nodes[order].astype(np.int32), np.bincount(np.searchsorted(roots, of), minlength=len(roots))),
             _lists(logs[order], np.bincount(np.searchsorted(roots, of), minlength=len(roots))),
             _lists((follows & 255).astype(np.int32), np.bincount(np.searchsorted(roots, follows >> 8), minlength=len(roots))),
             _lists(times, np.bincount(np.searchsorted(roots, follows >> 8), minlength=len(roots)))],
        )
        yield from (rows.slice(at, common.BATCH_ROWS) for at in range(0, len(rows), common.BATCH_ROWS))

    for rows in batches:
        n = _flat(rows, "counts").astype(np.int64)
        seen = n > 0
        waiting.append((_grams_of(rows)[seen], n[seen]))
        size += len(waiting[-1][1])
        if size >= _ASKED:
            values, counts = merged()
            waiting, size = [], 0
            # The last root may go on.
            ended = np.searchsorted(values, values[-1] >> 24 << 24)
            if ended:
                yield from weighed(values[:ended], counts[:ended])
                values, counts = values[ended:], counts[ended:]
    values, counts = merged()
    if len(values):
        yield from weighed(values, counts)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function for x > 0 by Stirling's series, shifted by eight."""
    shift = sum(np.log(x + i) for i in range(8))
    x = x + 8
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) - shift


def _kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - np.log(np.pi) - _log_gamma(zeros + ones + 1)


def _bits(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts by byte (contexts x 256) to zeros and ones at the 255 inner nodes of the bit tree:
    node 2^d - 1 + p is the prefix p of d bits."""
    zeros, ones = [], []
    for depth in range(8):
        split = rows.reshape(len(rows), 1 << depth, 2, -1).sum(axis=3, dtype=np.float64)
        zeros.append(split[:, :, 0])
        ones.append(split[:, :, 1])
    return np.concatenate(zeros, axis=1), np.concatenate(ones, axis=1)


def _in_blocks(function, *arrays: np.ndarray) -> np.ndarray:
    """Row by row functions without large temporaries."""
    size = max(len(a) for a in arrays)
    return np.concatenate([function(*(a[i : i + 512] for a in arrays)) for i in range(0, size, 512)])


def _log_estimates(rows: np.ndarray) -> np.ndarray:
    return _in_blocks(lambda r: _kt(*_bits(r)), rows)


def _next_bits(rows: np.ndarray) -> np.ndarray:
    def estimates(block):
        zeros, ones = _bits(block)
        return ((ones + 0.5) / (zeros + ones + 1)).astype(np.float32)

    return _in_blocks(estimates, rows)


def _by_byte(one: np.ndarray) -> np.ndarray:
    """Log10 probability of each byte from the probabilities of a one bit at the inner nodes."""
    total = np.zeros((len(one), 1))
    for depth in range(8):
        first = (1 << depth) - 1
        p = one[:, first : first + (1 << depth)].astype(np.float64)
        total = np.stack([total + np.log10(1 - p), total + np.log10(p)], axis=2).reshape(len(one), -1)
    return total.astype(np.float32)


def code_table(contexts: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(below, table): log10 probabilities of the 256 bytes at each context, and the row of the longer
    context that a further byte back leads to, or 0.

    ``contexts[d]`` holds the contexts of d bytes in ascending order (the latest byte lowest),
    ``counts[d]`` the counts by following byte. Row 0 is the empty context. Occurrences of a
    context in no longer context that the tree holds are those of a leaf of their own,
    which its row stands for."""
    depth = len(contexts) - 1
    rest, parents = [], []
    for d in range(depth + 1):
        left = counts[d].astype(np.float64)
        inner = np.zeros(len(left), bool)
        if d < depth:
            up = np.searchsorted(contexts[d], contexts[d + 1] & ((1 << 8 * d) - 1))
            np.subtract.at(left, up, counts[d + 1])
            inner[up] = True
            parents.append(up)
        rest.append((inner, left))
    stop, weighted = [None] * (depth + 1), None
    for d in range(depth, -1, -1):
        inner, left = rest[d]
        own = _log_estimates(counts[d])
        stop[d] = np.ones(own.shape, np.float32)
        if inner.any():
            below = _log_estimates(left)
            np.add.at(below, parents[d], weighted)
            mixed = np.logaddexp(own[inner], below[inner]) - np.log(2)
            stop[d][inner] = np.exp(own[inner] - np.log(2) - mixed)
            own[inner] = mixed
        weighted = own
    first = np.cumsum([0, *map(len, contexts)])
    below = np.zeros((first[-1], 256), np.int32)
    table = []
    gathered, share = np.zeros((1, 255), np.float32), np.ones((1, 255), np.float32)
    for d in range(depth + 1):
        estimate = _next_bits(counts[d])
        gathered = gathered + share * stop[d] * estimate
        share = share * (1 - stop[d])
        final = gathered + share * _next_bits(rest[d][1])
        table.append(_in_blocks(_by_byte, np.clip(final, 1e-9, 1 - 1e-7)))
        if d < depth:
            up = parents[d]
            below[first[d] + up, contexts[d + 1] >> 8 * d] = first[d + 1] + np.arange(len(up))
            gathered, share = gathered[up], share[up]
    return below, np.concatenate(table)


def shares(
    contexts: list[np.ndarray], counts: list[np.ndarray], deeper: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, gathered, share): what the estimates of contexts above the roots add to the probability of a one at each
    inner node, the share they leave to longer contexts, and the row of the longest known context by the last two bytes.

    Arguments as for ``code_table``, all contexts held; ``deeper`` has the summed log probabilities of the longer
    contexts of the deepest, by inner node."""
    stop: list[np.ndarray] = []
    below = deeper
    for d in range(len(contexts) - 1, -1, -1):
        own = _log_estimates(counts[d])
        weighted = np.logaddexp(own, below) - np.log(2)
        stop.insert(0, np.exp(own - np.log(2) - weighted).astype(np.float32))
        if d:
            up = np.searchsorted(contexts[d - 1], contexts[d] & ((1 << 8 * (d - 1)) - 1))
            below = np.zeros((len(contexts[d - 1]), 255))
            np.add.at(below, up, weighted)
    rows = np.zeros(1 << 8 * (TOP - 1), np.int32)
    known = np.arange(len(rows))
    gathered, share = [np.zeros((1, 255), np.float32)], [np.ones((1, 255), np.float32)]
    first = 0
    for d in range(len(contexts)):
        up = np.searchsorted(contexts[d - 1], contexts[d] & ((1 << 8 * (d - 1)) - 1)) if d else np.zeros(1, int)
        gathered.append(gathered[-1][up] + share[-1][up] * stop[d] * _next_bits(counts[d]))
        share.append(share[-1][up] * (1 - stop[d]))
        at = np.minimum(np.searchsorted(contexts[d], known & ((1 << 8 * d) - 1)), len(contexts[d]) - 1)
        rows = np.where(contexts[d][at] == known & ((1 << 8 * d) - 1), first + at, rows)
        first += len(contexts[d])
    return rows, np.concatenate(gathered[1:]), np.concatenate(share[1:])


def top(trained: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``shares`` of the contexts above the roots. At most 256 rows by context of two bytes reach the driver."""
    context = F.col("root").bitwiseAND((1 << 8 * (TOP - 1)) - 1).alias("context")

    def dense(key, value, width):
        each = trained.select(context, F.explode(F.arrays_zip(key, value)).alias("e"))
        summed = each.groupBy("context", F.col(f"e.{key}").alias("at")).agg(F.sum(f"e.{value}").alias("sum")).toArrow()
        of, at, total = (summed.column(c).to_numpy() for c in ("context", "at", "sum"))
        known, row = np.unique(of.astype(np.int64), return_inverse=True)
        out = np.zeros((len(known), width))
        out[row, at] = total
        return known, out

    known, times = dense("bytes", "times", 256)
    if not len(known):  # nothing to learn from
        return shares([np.zeros(1, np.int64)], [np.zeros((1, 256))], np.zeros((1, 255)))
    contexts, counts = [known], [times]
    for d in range(TOP - 2, -1, -1):
        shorter, row = np.unique(contexts[0] & ((1 << 8 * d) - 1), return_inverse=True)
        table = np.zeros((len(shorter), 256))
        np.add.at(table, row, counts[0])
        contexts.insert(0, shorter)
        counts.insert(0, table)
    return shares(contexts, counts, dense("nodes", "logs", 255)[1])


_PRICED = pa.schema([("block", pa.int64()), ("root", pa.int32()), ("grams", _INTS), ("logs", pa.list_(pa.float32()))])
_PRICED_SPARK = "block long, root int, grams array<int>, logs array<float>"


def _prices(grams: np.ndarray, n: np.ndarray, rows: np.ndarray, gathered: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Log10 probability of the byte of each gram after its context, of sorted distinct grams with training counts."""
    row = rows[grams >> 24 & ((1 << 8 * (TOP - 1)) - 1)]
    out = np.zeros(len(grams))
    for bit, (one, _, _) in enumerate(subtrees(grams, n)):
        node = (1 << bit) - 1 + ((grams & 255) >> (8 - bit))
        p = np.clip(gathered[row, node] + share[row, node] * one, 1e-9, 1 - 1e-7)
        out += np.log10(np.where(grams >> (7 - bit) & 1, p, 1 - p))
    return out.astype(np.float32)


def priced(asks: DataFrame, trained: DataFrame, above, partitions: int) -> DataFrame:
    """(block, root, grams, logs): log10 probabilities of the grams that the blocks ask for."""
    shared = asks.sparkSession.sparkContext.broadcast(above)

    def of_batches(batches):
        rows, gathered, share = shared.value
        held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting, size = [], 0

        def answered():
            nonlocal held
            grams = np.concatenate([_grams_of(r) for r in waiting])
            n = np.concatenate([_flat(r, "counts") for r in waiting])  # blocks have none
            sizes = np.concatenate([np.diff(r.column("grams").offsets.to_numpy()) for r in waiting])
            model = np.repeat(np.concatenate([r.column("block").to_numpy() for r in waiting]) < 0, sizes)
            # A root's training counts come first; those of the last may serve further rows.
            known = np.concatenate([held[0], grams[model]]), np.concatenate([held[1], n])
            values, counts = _merged(
                np.concatenate([known[0], grams[~model]]), np.concatenate([known[1], np.zeros((~model).sum())])
            )
            logs = _prices(values, counts, rows, gathered, share)
            last = known[0] >> 24 == grams[-1] >> 24
            held = known[0][last], known[1][last]
            for r in waiting:
                own = r.filter(pa.array(r.column("block").to_numpy() >= 0))
                if len(own):
                    found = logs[np.searchsorted(values, _grams_of(own))]
                    yield common.batch(
                        _PRICED,
                        [own.column("block"), own.column("root"), own.column("grams"),
                         _lists(found, np.diff(own.column("grams").offsets.to_numpy()))],
                    )

        for batch in batches:
            if not len(batch):
                continue
            waiting.append(batch)
            size += len(batch.column("grams").flatten())
            if size >= _ASKED:
                yield from answered()
                waiting, size = [], 0
        if waiting:
            yield from answered()

    model = trained.select(F.lit(-1).cast("long").alias("block"), "root", "grams", "counts")
    wanted = asks.select("block", "root", "grams", F.lit(None).cast("array<long>").alias("counts"))
    dealt = model.unionByName(wanted).repartition(partitions, "root").sortWithinPartitions("root", "block")
    return dealt.mapInArrow(of_batches, _PRICED_SPARK)


def text_score(text: bytes, below: np.ndarray, table: np.ndarray, depth: int = DEPTH) -> float:
    """Log10 probability of a text and its end."""
    padded = np.frombuffer(b"\0" * depth + text + b"\0", np.uint8)
    size = len(text) + 1
    row = below[0, padded[depth - 1 : depth - 1 + size]]
    state = row
    for back in range(2, depth + 1):
        # Row 0 has children, but none of the rows that end there may go on.
        state = np.where(state > 0, below[state, padded[depth - back : depth - back + size]], 0)
        row = np.where(state > 0, state, row)
    return float(table[row, padded[depth:]].sum(dtype=np.float64))


_SCORED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
     ("n_bytes", pa.int64()), ("logs", pa.float64()), ("score", pa.float64())]
)
_SCORED_SPARK = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, n_bytes long, logs double, score double"
)


def _scores(texts: list[bytes], grams: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Log10 probabilities of texts and their ends, by sorted grams that hold all of theirs."""
    found = [followed(text) for text in texts]
    # Sorted by gram and text: equal grams are looked up once, and in order.
    placed = np.concatenate(found).astype(np.uint64) << np.uint64(16)
    placed |= np.repeat(np.arange(len(texts), dtype=np.uint64), [len(f) for f in found])
    placed, n = np.unique(placed, return_counts=True)
    at = np.searchsorted(grams, (placed >> np.uint64(16)).astype(np.int64))
    return np.bincount((placed & np.uint64(0xFFFF)).astype(np.int64), n * logs[at].astype(np.float64), len(texts))


def _scored(batches):
    """Of one block after another, its tokens and grams (no text) before its texts."""
    block, tokens, grams, logs, ordered = None, {}, [], [], False
    for rows in batches:
        blocks = rows.column("block").to_numpy()
        for of in np.unique(blocks).tolist():
            if of != block:
                block, tokens, grams, logs, ordered = of, {}, [], [], False
            own = rows.filter(pa.array(blocks == of))
            known = own.filter(own.column("token").is_valid())
            counts = np.log10(known.column("c").to_numpy(zero_copy_only=False) + 1.0).tolist()
            tokens.update(zip(known.column("token").to_pylist(), counts, strict=True))
            known = own.filter(own.column("root").is_valid())
            if len(known):
                grams.append(_grams_of(known))
                logs.append(_flat(known, "logs"))
            own = own.filter(own.column("text").is_valid())
            if not len(own):
                continue
            if not ordered:
                grams, logs = [np.concatenate(grams)], [np.concatenate(logs)]
                order = np.argsort(grams[0], kind="stable")
                grams, logs, ordered = [grams[0][order]], [logs[0][order]], True
            texts = own.column("text").to_pylist()
            out = []
            for text in texts:
                words = tokens_of(text)
                found = [log for log in map(tokens.get, words) if log is not None]
                out.append((len(words), len(found), len(text), sum(found)))
            n_tokens, n_known, n_bytes, sums = map(list, zip(*out, strict=True))
            value = _scores(texts, grams[0], logs[0])
            yield common.batch(
                _SCORED, [own.column("doc_id"), own.column("held_out"), n_tokens, n_known, n_bytes, sums, value]
            )


def score(docs: DataFrame, train) -> DataFrame:
    """Code lengths and unigram scores of every row of ``docs``, learnt from the rows that satisfy
    ``train``: doc_id, held_out (not ``train``), n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte.

    Null texts are empty: one token, the end. With nothing to learn from, every byte costs eight
    bits. A null doc_id counts as empty text in the fold. Repeated rows give repeated results;
    other columns are ignored. An empty table gives an empty result."""
    common.small_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long"),
        (~F.coalesce(train, F.lit(False))).alias("held_out"),
        common.utf8(F.col("text")).alias("text"),
        F.spark_partition_id().alias("part"),
    )
    rows = stored(rows.mapInArrow(_dealt, _DEALT_SPARK), "blocks")
    part, run = F.col("block").bitwiseAND((1 << 32) - 1), F.shiftright("block", 32)
    blocks, parts = rows.agg(F.countDistinct("block"), F.coalesce(F.max(part) + 1, F.lit(1))).first()
    blocks = blocks or 1
    asked = rows.select("block", (~F.col("held_out")).alias("train"), "text").mapInArrow(_asked, _ASKS_SPARK)
    asked = stored(asked, "asked")

    # Windows, not a join: a token has a row for each block that holds it.
    alike = Window.partitionBy("token")
    tokens = asked.where("token IS NOT NULL").select(
        "block",
        "token",
        F.sum("n").over(alike).alias("c"),
        F.row_number().over(alike.orderBy("block")).alias("nth"),
    )
    tokens = stored(tokens.where("c > 0"), "token-counts")
    total, distinct = tokens.where("nth = 1").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()

    asks = asked.where("root IS NOT NULL").select("block", "root", "grams", "counts")
    rooted = asks.repartition(blocks, "root").sortWithinPartitions("root").select("root", "grams", "counts")
    trained = stored(rooted.mapInArrow(_trained, _TRAINED_SPARK), "contexts")
    answers = priced(asks, trained, top(trained), blocks)

    given = (
        rows.unionByName(tokens.select("block", "token", "c"), allowMissingColumns=True)
        .unionByName(answers, allowMissingColumns=True)
        .repartitionById(blocks, F.pmod(part + run * parts, F.lit(blocks)).cast("int"))
        .sortWithinPartitions("block", F.col("text").isNotNull())
    )
    floor = float(np.log10(total + distinct + 1))
    return given.mapInArrow(_scored, _SCORED_SPARK).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * floor).alias("base_score"),
        "score",
        (-F.col("score") * float(np.log2(10)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )


def query(docs: DataFrame) -> DataFrame:
    return score(docs, common.fold(F.col("doc_id"), FOLDS) != HELD_OUT)
