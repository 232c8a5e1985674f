"""Token counts by finite-state tokenizer compilation (operator 5).

A byte-level BPE tokenizer is compiled into two deterministic transducers:

* the *word-boundary transducer* reads code-point classes. Its states say
  what the open pretoken is (a space, a longer run of white space, letters,
  digits, other signs, an apostrophe that may begin a contraction, ...); each
  transition carries two output bits, "a pretoken begins here" and "a
  pretoken began one code point before" (look-ahead by one);
* the *merge transducer* reads one pretoken per step and its transition
  carries the number of tokens emitted. Transitions are determinised from
  the vocabulary's merge ranks when first met and kept.

A batch of texts is laid out as one sequence with end marks and cut into
equal chunks. All chunks run at once, each from every state, until their
paths meet; that gives each chunk's state map (entry state -> exit state).
The maps compose by a parallel prefix scan, which gives every chunk's entry
state; then only the part before the paths met is run again to fix its
output bits. A text of any length is so counted whole, without prefixes.

Results: a null text counts as empty (0 bytes, 0 tokens); a repeated row is
counted on its own; the special string of the vocabulary counts as one
token wherever it stands, as the vocabulary's own library does by default.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

CHUNK = 1024            # code points a chunk
BATCH = 4_000_000       # code points laid out at once
KEPT = 600_000          # transitions of the merge transducer kept at once
WIDE = 64               # bytes; longer pretokens are merged one by one
NEVER = 1 << 40         # rank of neighbours that don't merge
BASES = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
NONE_KEPT = np.zeros(1, dtype=np.uint64), np.zeros(1, dtype=np.uint64), np.zeros(1, dtype=np.int64)

# classes of code points
SP, WS, LET, ONE, R_, V_, E_, L_, NUM, OTH, APO, END = range(12)
# states: what the open pretoken is
FRESH, SP1, WS1, SPN, WSN, LETS, NUMS, OTHS, APO0, APO_R, APO_V, APO_L = range(12)
BEGINS, BEGAN = 1, 2    # output bits


def class_table(library_splits=None) -> bytes:
    """The class of every code point, as one byte each. Code points that only
    some versions of Unicode know as letters or numbers are asked for:
    ``library_splits(text)`` gives the places where pretokens begin."""
    table = np.full(0x110000, OTH, dtype=np.uint8)
    kinds = {"L": LET, "N": NUM}
    cats = [unicodedata.category(chr(cp)) for cp in range(0x110000)]
    table[:] = [kinds.get(c[0], OTH) for c in cats]
    unknown = "".join(chr(cp) for cp, c in enumerate(cats) if c == "Cn")
    unsure = [ord(x) for x in regex.findall(r"[\p{L}\p{N}]", unknown)]
    if library_splits and unsure:
        begins = library_splits("".join(f"a{chr(cp)}1\n" for cp in unsure))
        for k, cp in enumerate(unsure):
            kind = 4 * k + 1 in begins, 4 * k + 2 in begins
            table[cp] = {(False, True): LET, (True, False): NUM}.get(kind, OTH)
    # fixed values: white space, and the letters that end a contraction
    for cp in (*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
        table[cp] = WS
    for letters, kind in ((" ", SP), ("stmd", ONE), ("r", R_), ("v", V_), ("e", E_), ("l", L_), ("'", APO)):
        for x in letters:
            table[ord(x)] = kind
    return table.tobytes()


def boundary_transducer() -> tuple[np.ndarray, np.ndarray]:
    """(next state, output bits), each indexed by state * 12 + class."""
    letters = (LET, ONE, R_, V_, E_, L_)
    opens = {SP: SP1, WS: WS1, NUM: NUMS, OTH: OTHS, APO: APO0, END: FRESH} | dict.fromkeys(letters, LETS)
    rules: dict[tuple[int, int], tuple[int, int]] = {}
    for state in range(12):
        for kind in range(12):
            rules[state, kind] = opens[kind], BEGINS       # a new pretoken, unless a rule below says otherwise
    for kind in (*letters, NUM, OTH, APO):
        joined = {NUM: NUMS, OTH: OTHS, APO: OTHS}.get(kind, LETS)
        rules[SP1, kind] = joined, 0                        # one space goes with what follows
        rules[SPN, kind] = joined, BEGAN                    # so does the last space of a longer run
        rules[WSN, kind] = opens[kind], BEGINS | BEGAN      # other white space stands alone
    for state in (SP1, WS1, SPN, WSN):
        rules[state, SP], rules[state, WS] = (SPN, 0), (WSN, 0)
    for kind in letters:
        rules[LETS, kind] = LETS, 0
    rules[NUMS, NUM] = NUMS, 0
    for state in (OTHS, APO0):
        rules[state, OTH] = rules[state, APO] = OTHS, 0
    rules[APO0, ONE] = FRESH, 0                             # 's 't 'm 'd
    rules[APO0, R_], rules[APO0, V_], rules[APO0, L_] = (APO_R, 0), (APO_V, 0), (APO_L, 0)
    for state, last in ((APO_R, E_), (APO_V, E_), (APO_L, L_)):
        for kind in range(12):                              # no contraction: the letter began a pretoken
            to, out = rules[LETS, kind]
            rules[state, kind] = to, out | BEGAN
        rules[state, last] = FRESH, 0                       # 're 've 'll
    to, out = zip(*(rules[s, k] for s in range(12) for k in range(12)), strict=True)
    return np.array(to, dtype=np.intp), np.array(out, dtype=np.uint8)


class MergeTransducer:
    """One transition a pretoken, annotated with the tokens it emits."""

    def __init__(self, vocabulary: dict):
        model = vocabulary["model"]
        ids, pairs = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.size = max(ids.values()) + 1
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs] or [-1], dtype=np.int64)
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]
        self.makes = np.array([ids[a + b] for a, b in pairs] or [0], dtype=np.int64)
        # the visible stand-in of each byte in the vocabulary's spelling
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        spare = iter(range(256, 512))
        self.byte_id = np.array([ids[chr(b) if b in plain else chr(next(spare))] for b in range(256)], dtype=np.int64)
        self.special = [t["content"] for t in vocabulary.get("added_tokens", [])]
        self.order = None
        self.kept = NONE_KEPT

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of merging neighbours a and b; NEVER where they don't merge."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], NEVER)

    def long_emitted(self, data: np.ndarray) -> int:
        """Tokens of one long pretoken, by a queue of neighbours."""
        part = self.byte_id[data]
        n = len(part)
        first = self.rank(part[:-1], part[1:])
        part = part.tolist()
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        if self.order is None:
            self.order = dict(zip(self.keys.tolist(), self.rank_of.tolist(), strict=True))
        order = self.order
        queue = [(r, i, part[i], part[i + 1]) for i, r in enumerate(first.tolist()) if r < NEVER]
        heapq.heapify(queue)
        count = n
        while queue:
            rank, i, a, b = heapq.heappop(queue)
            j = right[i]
            if part[i] != a or j >= n or part[j] != b:
                continue
            part[i], part[j] = int(self.makes[rank]), -1
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            count -= 1
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (r := order.get(part[x] * self.size + part[y])) is not None:
                    heapq.heappush(queue, (r, x, part[x], part[y]))
        return count

    def emitted(self, data: np.ndarray, begin: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
        """Tokens of many pretokens of ``data`` at once: in each, the
        best-ranked neighbours merge, leftmost first, until none merge."""
        n = len(begin)
        at = np.minimum(begin[:, None] + np.arange(width), len(data) - 1)
        part = self.byte_id[data[at]]
        ranks = np.full((n, width), NEVER, dtype=np.int64)
        inside = np.arange(1, width)[None, :] < sizes[:, None]
        ranks[:, :-1] = np.where(inside, self.rank(part[:, :-1], part[:, 1:]), NEVER)
        right = np.repeat(np.arange(1, width + 1)[None, :], n, axis=0)
        left = np.repeat(np.arange(-1, width - 1)[None, :], n, axis=0)
        counts, row = sizes.copy(), np.arange(n)
        while len(row):
            i = ranks[row].argmin(axis=1)
            rank = ranks[row, i]
            live = rank < NEVER
            row, i, rank = row[live], i[live], rank[live]
            if not len(row):
                break
            j = right[row, i]
            after = right[row, j]
            part[row, i], right[row, i], ranks[row, j] = self.makes[rank], after, NEVER
            counts[row] -= 1
            more = after < sizes[row]
            ranks[row[~more], i[~more]] = NEVER
            r, x, y = row[more], i[more], after[more]
            left[r, y] = x
            ranks[r, x] = self.rank(part[r, x], part[r, y])
            before = left[row, i]
            has = before >= 0
            r, x, y = row[has], before[has], i[has]
            ranks[r, x] = self.rank(part[r, x], part[r, y])
        return counts

    def determinise(self, data: np.ndarray, begin: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """The output of pretokens not met before."""
        sizes, out = upto - begin, np.zeros(len(begin), dtype=np.int64)
        for low, high in ((0, 8), (8, 16), (16, WIDE)):
            among = np.flatnonzero((sizes > low) & (sizes <= high))
            step = 2_000_000 // (8 * high)
            for k in range(0, len(among), step):
                some = among[k:k + step]
                out[some] = self.emitted(data, begin[some], sizes[some], high)
        for k in np.flatnonzero(sizes > WIDE).tolist():
            out[k] = self.long_emitted(data[begin[k]:upto[k]])
        return out

    def counts(self, data: np.ndarray, begin: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Output of every pretoken ``data[begin:upto]``. Equal pretokens are
        found by two 64-bit polynomial hashes."""
        one, two = (self.hashes(data, begin, upto, base) for base in BASES)
        distinct, first, inverse = np.unique(one, return_index=True, return_inverse=True)
        if (two[first][inverse] != two).any():          # one hash does not tell them apart
            distinct, first, inverse = np.unique(one ^ (two * np.uint64(BASES[0])), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.kept[0], distinct), len(self.kept[0]) - 1)
        known = (self.kept[0][at] == distinct) & (self.kept[1][at] == two[first])
        out = np.where(known, self.kept[2][at], 0)
        new = np.flatnonzero(~known)
        out[new] = self.determinise(data, begin[first[new]], upto[first[new]])
        if len(self.kept[0]) + len(new) > KEPT:
            self.kept = NONE_KEPT
        both = [np.concatenate(x) for x in zip(self.kept, (distinct[new], two[first[new]], out[new]), strict=True)]
        order = np.argsort(both[0], kind="stable")
        self.kept = tuple(x[order] for x in both)
        return out[inverse]

    @staticmethod
    def hashes(data: np.ndarray, begin: np.ndarray, upto: np.ndarray, base: int) -> np.ndarray:
        """Sum of byte * base^place, places counted from each pretoken's begin."""
        n, inverse = len(data), pow(base, -1, 1 << 64)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(n, base, dtype=np.uint64))
            sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((data + np.uint64(1)) * powers)])
            back = np.cumprod(np.full(n + 1, inverse, dtype=np.uint64))
            return (sums[upto] - sums[begin]) * back[begin]


def compose(maps: np.ndarray) -> np.ndarray:
    """Inclusive parallel prefix scan of state maps: row i becomes the map of
    chunks 0..i together."""
    done, step = maps.copy(), 1
    while step < len(done):
        done[step:] = np.take_along_axis(done[step:], done[:-step], axis=1)
        step *= 2
    return done


def boundaries(classes: np.ndarray, to: np.ndarray, out: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Places where a pretoken begins, by chunks run side by side."""
    n = len(classes)
    lanes = -(-n // chunk)
    grid = np.full(lanes * chunk, END, dtype=np.intp)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(lanes, chunk).T)
    bits = np.zeros((chunk, lanes), dtype=np.uint8)
    every = np.repeat(np.arange(12, dtype=np.intp)[:, None], lanes, axis=1)
    met = 0
    while met < chunk:                      # from every state, until the paths meet
        every = to[every * 12 + grid[met]]
        met += 1
        if met % 16 == 0 and (every == every[0]).all():
            break
    state = every[0]
    for t in range(met, chunk):             # one path from there on
        at = state * 12 + grid[t]
        bits[t] = out[at]
        state = to[at]
    exits = np.repeat(state[:, None], 12, axis=1) if met < chunk else every.T
    entry = np.full(lanes, FRESH, dtype=np.intp)
    entry[1:] = compose(np.ascontiguousarray(exits))[:-1, FRESH]
    state = entry
    for t in range(met):                    # what came before, now with the entry state known
        at = state * 12 + grid[t]
        bits[t] = out[at]
        state = to[at]
    flat = bits.T.reshape(-1)[:n]
    begins = (flat & BEGINS) > 0
    begins[:-1] |= (flat[1:] & BEGAN) > 0
    return np.flatnonzero(begins)


def count_batch(texts: list[str], table: np.ndarray, dfa, merger: MergeTransducer, chunk: int = CHUNK) -> np.ndarray:
    """Tokens of each text of a batch."""
    totals = np.zeros(len(texts), dtype=np.int64)
    pieces, owner = [], []
    for i, text in enumerate(texts):
        parts = [text]
        for special in merger.special:
            if special in text:
                parts = [x for p in parts for x in p.split(special)]
        totals[i] = len(parts) - 1
        pieces += parts
        owner += [i] * len(parts)
    laid = "\n".join(pieces) + "\n"
    points = np.frombuffer(laid.encode("utf-32-le"), dtype=np.uint32)
    classes = table[points]
    ends = np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) + 1) - 1
    classes[ends] = END
    begins = boundaries(classes, *dfa, chunk=chunk)
    upto = np.append(begins[1:], len(laid))
    real = classes[begins] != END
    begins, upto = begins[real], upto[real]
    data = np.frombuffer(laid.encode(), dtype=np.uint8)
    place = np.zeros(len(points) + 1, dtype=np.int64)       # of each code point, in bytes
    np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000), out=place[1:])
    counts = merger.counts(data, place[begins], place[upto])
    whose = np.asarray(owner, dtype=np.int64)[np.searchsorted(ends, begins)]
    return totals + np.bincount(whose, weights=counts, minlength=len(texts)).astype(np.int64)


def counter(vocabulary, table):
    """The task function; both arguments are broadcasts of fixed size."""

    def run(batches):
        merger = MergeTransducer(json.loads(vocabulary.value))
        classes = np.frombuffer(table.value, dtype=np.uint8)
        dfa = boundary_transducer()
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            parts, size, first = [], 0, 0
            for i, text in enumerate(texts):
                size += len(text)
                if size >= BATCH or i == len(texts) - 1:
                    parts.append(count_batch(texts[first:i + 1], classes, dfa, merger))
                    first, size = i + 1, 0
            counts = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts)], names=["key", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text",
                 limit: int = 1024) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    The vocabulary file is read on the driver and broadcast (its size does
    not depend on the data). Nothing is shuffled."""
    sc = docs.sparkSession.sparkContext
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = f.read()
    split = Tokenizer.from_str(vocabulary).pre_tokenizer.pre_tokenize_str
    table = class_table(lambda x: {place[0] for _, place in split(x)})
    run = counter(sc.broadcast(vocabulary), sc.broadcast(table))
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
