"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of distinct word 5-shingles (52-bit hashes). Documents
with equal sets are one *node*, named by a hash of the set, so a group of
copies costs one node however large it is.

Tokens have one global order: by level of document frequency, estimated from
a fixed-size table of bucket counts over all documents, then by hash. For a
threshold t, a set of n tokens and a multiplicity k, the first
n - ceil(t n) + k tokens are its k-prefix. Two sets x, y with Jaccard >= t
share at least min over both of (required overlap - tokens after the prefix)
tokens of their prefixes, which is k or more. Each document chooses its own k:
the one of least estimated cost, postings read plus candidates left, where at
most (postings / k) candidates can share k tokens.

1. Signatures: node and size of each document, and the bucket counts.
2. Postings: prefix tokens, shuffled by token. Tokens of a single node go,
   then nodes that share fewer tokens than any link needs.
3. Pivot links: each token names the node of most shared tokens as its pivot
   (of a group of near copies, the one with fewest edits), and every node is
   verified exactly with the pivot that it shares most tokens with. This joins
   large groups of near copies with one pair per node.
4. Remaining links: all pairs of nodes *in different components* that share
   enough prefix tokens, verified exactly. Pairs inside a component can't
   change it, so no link between components is lost. At a token, a pair goes
   on only if both nodes' lists of shared tokens can have enough in common:
   parity bits of the lists differ in at most as many places as the lists
   differ in tokens, which bounds the overlap from above. Large token groups
   are split into pairs of blocks. ``similar_pairs`` lists all pairs instead.
5. Components of the links, and the smallest doc_id of each.

Verification reads the full token sets of both nodes. Sets are rebuilt from
the texts for the nodes concerned (a fixed-size bit table says which).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm import flat
from statloom.llm.components import components
from statloom.llm.shared import Tables, shuffle_partitions

SHINGLE = 5
PERCENT = 75
TOKEN_BITS = 52
#: Rows of a block: with TOKEN_BITS they fill 64 bits.
BLOCK_ROWS = 1 << (64 - TOKEN_BITS)
#: Buckets of the frequency table, and bits of the table of nodes to verify (both fixed).
BUCKETS = 1 << 20
NODE_BITS = 1 << 23
SLICES = 64
#: Cost of comparing two sets, in postings for each of their tokens.
VERIFY_COST = 0.5
#: Documents that share a token which the bucket counts show nothing of.
UNSEEN = 0.02
#: Every multiplicity is at least this part (a tenth) of the set, so that partners can rely on it.
LEAST_PART = 10
#: Bytes of text that are cut into sets at a time.
BLOCK_BYTES = 2 << 20
#: Nodes of a block of a token group.
GROUP_NODES = 2048
#: Postings of a part in which pairs are looked for, and the least number of parts.
PART_POSTINGS, LEAST_PARTS = 500_000, 16
#: Tokens of one group of postings.
GROUP_TOKENS = 1 << 21


class Sets:
    """Distinct shingle tokens of a block's rows: sorted within each row."""

    def __init__(self, block: pa.RecordBatch):
        words = flat.find_words(*flat.text_buffer(block.column("text")), flat.SPACED_LOWER)
        count = np.diff(words.row_first)
        at, h = flat.window_hashes(words, SHINGLE, seed=301)
        rows, hashes = [words.row[at]], [h]
        for k in range(1, SHINGLE):  # shorter rows: the whole sequence is one shingle
            short = np.flatnonzero(count == k)
            if len(short):
                total = np.full(len(short), seed_of(k))
                for j in range(k):
                    total = flat.mix(total * flat.ODD + words.hash[words.row_first[short] + j])
                rows.append(short)
                hashes.append(total)
        key = (np.concatenate(rows).astype(np.uint64) << np.uint64(TOKEN_BITS)) | (np.concatenate(hashes) >> np.uint64(64 - TOKEN_BITS))
        key.sort()
        key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
        self.row = (key >> np.uint64(TOKEN_BITS)).astype(np.int64)
        self.token = key & np.uint64((1 << TOKEN_BITS) - 1)
        self.first = np.searchsorted(self.row, np.arange(block.num_rows + 1))
        self.size = np.diff(self.first)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat.mix(self.token + flat.ODD))])
        self.node = flat.mix((total[self.first[1:]] - total[self.first[:-1]]) ^ self.size.astype(np.uint64)).view(np.int64)

    def distinct_rows(self) -> np.ndarray:
        """The first row of each distinct set that is not empty."""
        rows = np.flatnonzero(self.size)
        return np.sort(rows[np.unique(self.node[rows], return_index=True)[1]])


def seed_of(k: int) -> np.uint64:
    return flat.seeded(SHINGLE, 401)[k]


def bucket(token: np.ndarray) -> np.ndarray:
    return (token >> np.uint64(TOKEN_BITS - 20)).astype(np.int64)


# ------------------------------------------------------------------ 1. signatures

_SIGNATURE = "doc_id long, text_hash long, node long, n int, slice int, counts binary"


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, np.int64)
    for block in flat.blocks(batches, size=BLOCK_BYTES, rows=BLOCK_ROWS):
        sets = Sets(block)
        fresh = np.zeros(block.num_rows, bool)
        fresh[sets.distinct_rows()] = True
        counts += np.bincount(bucket(sets.token[fresh[sets.row]]), minlength=BUCKETS)
        n, none = block.num_rows, pa.nulls(block.num_rows, pa.int32())
        yield pa.record_batch([block.column("doc_id"), block.column("text_hash"), pa.array(sets.node, mask=sets.size == 0), pa.array(sets.size, pa.int32()),
                               none, pa.nulls(n, pa.binary())], ["doc_id", "text_hash", "node", "n", "slice", "counts"])
    if counts.any():
        parts = [flat.narrow(x) for x in np.split(counts, SLICES)]
        empty = [pa.nulls(SLICES, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int32())]
        yield pa.record_batch([*empty, pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())],
                              ["doc_id", "text_hash", "node", "n", "slice", "counts"])


def _add_counts(table: pa.Table) -> pa.Table:
    total = sum(flat.wide(x) for x in table.column("counts").to_pylist())
    return pa.table({"slice": table.column("slice")[:1], "counts": pa.array([flat.narrow(total)], pa.binary())})


def _levels(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(level, documents beyond the first) of each bucket: the level is 0 where random tokens would fill it as much."""
    usual = float(np.median(counts))
    often = counts - usual
    often[often < 5 * np.sqrt(usual + 1)] = 0
    return np.ceil(np.log2(often + 1)).astype(np.uint8), np.maximum(often, UNSEEN).astype(np.float32)


# ------------------------------------------------------------------ 2. postings


def needed(n, m, percent: int):
    """Smallest overlap of sets of n and m tokens that reaches the threshold."""
    return -(-percent * (n + m) // (100 + percent))


def choose_prefix(size: np.ndarray, first: np.ndarray, others: np.ndarray, percent: int) -> np.ndarray:
    """Prefix length of each row: its multiplicity k has the least estimated cost.

    ``others`` estimates, for every token in prefix order, how many more
    documents have it. A prefix costs its own postings, and the candidates
    that may share k of its tokens: at most (others in the prefix) / k, each
    at the cost of comparing two whole sets.
    """
    total = np.concatenate([[0.0], np.cumsum(others, dtype=np.float64)])
    must = -(-percent * size // 100)  # tokens that a partner must share at least
    best, best_cost = size, np.full(len(size), np.inf)
    k = 1
    while k < 2 * max(1, int(must.max(initial=0))):
        use = np.minimum(np.maximum(k, size // LEAST_PART), np.maximum(must, 1))
        length = np.minimum(size - must + use, size)
        cost = length + VERIFY_COST * size * (total[first[:-1] + length] - total[first[:-1]]) / use
        better = cost < best_cost
        best, best_cost = np.where(better, length, best), np.where(better, cost, best_cost)
        k *= 2
    return best


_POSTING = "part int, nodes binary, sizes binary, prefixes binary, counts binary, tokens binary"


def pack7(token: np.ndarray) -> bytes:
    return np.ascontiguousarray(token.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]).tobytes()


def unpack7(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(data, np.uint8).reshape(-1, 7)
    return out.view("<u8").ravel()


def _prefixes(tables, parts: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, often = tables.value
        for block in flat.blocks(batches, size=BLOCK_BYTES, rows=BLOCK_ROWS):
            sets = Sets(block)
            fresh = np.zeros(block.num_rows, bool)
            fresh[sets.distinct_rows()] = True
            keep = fresh[sets.row]
            row, token = sets.row[keep], sets.token[keep]
            size = np.where(fresh, sets.size, 0)
            first = np.concatenate([[0], np.cumsum(size)])
            cell = bucket(token)
            order = np.argsort((row * 32 + level[cell]).astype(np.uint32), kind="stable")
            token, cell = token[order], cell[order]
            length = choose_prefix(size, first, often[cell], percent)
            inside = np.arange(len(token)) - first[row] < length[row]
            row, token = row[inside], token[inside]
            part = (flat.mix(token) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((row, part)) if parts > 1 else np.arange(len(row))
            rows = []
            for p, r, t in flat.cut_by(part[order], row[order], token[order]):
                own, counts = np.unique(r, return_counts=True)
                rows.append((p, sets.node[own].tobytes(), flat.narrow(size[own]), flat.narrow(length[own]), flat.narrow(counts), pack7(t)))
            for i in range(0, len(rows), 64):
                columns = list(zip(*rows[i : i + 64], strict=True))
                yield pa.record_batch([pa.array(c, pa.binary() if j else pa.int32()) for j, c in enumerate(columns)],
                                      ["part", "nodes", "sizes", "prefixes", "counts", "tokens"])

    return run


_SHARED = "token long, node long, n int, prefix int"


def _shared_tokens(table: pa.Table) -> pa.Table:
    """Postings of the tokens that two nodes or more have."""
    rows = table.to_pylist()
    token = np.concatenate([unpack7(r["tokens"]) for r in rows])
    ranked = np.sort(token)
    twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    kept = []
    for r in rows:
        t = unpack7(r["tokens"])
        hit = twice[np.minimum(np.searchsorted(twice, t), len(twice) - 1)] == t if len(twice) else np.zeros(len(t), bool)
        run = np.repeat(np.arange(len(r["nodes"]) // 8), flat.wide(r["counts"]))[hit]
        kept.append((t[hit], np.frombuffer(r["nodes"], np.int64)[run], flat.wide(r["sizes"])[run], flat.wide(r["prefixes"])[run]))
    token, node, n, prefix = (np.concatenate(x) for x in zip(*kept, strict=True))
    order = np.lexsort((node, token))
    token, node, n, prefix = token[order], node[order], n[order], prefix[order]
    once = np.ones(len(token), bool)  # a node may come from several blocks
    once[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
    token, node, n, prefix = token[once], node[once], n[once], prefix[once]
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(token)))
    several = np.repeat(count > 1, count)
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.table([pa.array(c[several], t) for c, t in zip((token.view(np.int64), node, n, prefix), kinds, strict=True)], ["token", "node", "n", "prefix"])


def _required(n: str, prefix: str, m: str, prefix2: str, percent: int) -> F.Column:
    """Prefix tokens that a pair at the threshold must share."""
    overlap = F.ceil(F.lit(percent) * (F.col(n) + F.col(m)) / F.lit(100 + percent))
    return F.least(overlap - F.col(n) + F.col(prefix), overlap - F.col(m) + F.col(prefix2))


def _alike(n: str, m: str, percent: int) -> F.Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


# ------------------------------------------------------------------ 3, 4. candidates and verification

#: Bits of a list entry that hold the token's frequency among open postings, above the token itself.
FREQUENCY_TOP = (1 << (64 - TOKEN_BITS)) - 1
#: 64-bit words of parity bits of a list.
PARITY_WORDS = 8
_LISTED = ["part", "node", "n", "prefix", "component", "c", "parity", "keys", "low", "high", "own"]
_LISTED_DDL = "part int, node long, n int, prefix int, component long, c int, parity binary, keys binary, low binary, high binary, own binary"
_PAIR = "u long, v long"


def parity(keys: np.ndarray) -> np.ndarray:
    """Parity bits of a list of tokens: a bit is set if an odd number of tokens fall on it."""
    place = (flat.mix(keys & np.uint64((1 << TOKEN_BITS) - 1)) % np.uint64(64 * PARITY_WORDS)).astype(np.int64)
    odd = (np.bincount(place, minlength=64 * PARITY_WORDS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.uint64)


def _generators(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per node and part: the node's parity bits, and those of its shared tokens that belong to the part.

        Lists are in the common order: rare tokens first, then by hash. A link
        shares ``least`` tokens or more, so its first common token is among all
        but the last least - 1 of either list; only those are dealt to parts.
        A token of many nodes is dealt as pairs of blocks (low, high) of nodes.
        """
        for batch in batches:
            tokens, dfs = (batch.column(c) for c in ("tokens", "dfs"))
            rows = []
            for r, (node, n, prefix, component, least) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("node", "n", "prefix", "component", "least")), strict=True)):
                token, df = np.array(tokens[r].as_py(), np.int64).view(np.uint64), np.array(dfs[r].as_py(), np.int64)
                keys = (np.minimum(df, FREQUENCY_TOP).astype(np.uint64) << np.uint64(TOKEN_BITS)) | token
                order = np.argsort(keys)[: max(len(keys) - least + 1, 0)]
                bits, c = parity(keys).tobytes(), len(keys)
                keys, blocks = keys[order], -(-df[order] // GROUP_NODES)
                own = (flat.mix(keys ^ flat.mix(np.array([node], np.int64).view(np.uint64))) % blocks.astype(np.uint64)).astype(np.int64)
                other = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                keys, own = np.repeat(keys, blocks), np.repeat(own, blocks)
                low, high = np.minimum(own, other), np.maximum(own, other)
                part = (flat.mix(keys ^ flat.mix((low * (1 << 20) + high).astype(np.uint64))) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                rows += [(p, node, n, prefix, component, c, bits, k.tobytes(), *(x.astype(np.uint32).tobytes() for x in blocks_of))
                         for p, k, *blocks_of in flat.cut_by(part[order], keys[order], low[order], high[order], own[order])]
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 5)
            for i in range(0, max(len(rows), 1), 5000):
                columns = list(zip(*rows[i : i + 5000], strict=True)) or [()] * len(kinds)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], _LISTED)

    return run


def _listed(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Pairs of this part's token groups that can share enough tokens, each once."""
        node, n, prefix, comp, c = (table.column(x).to_numpy().astype(np.int64) for x in ("node", "n", "prefix", "component", "c"))
        bits = np.frombuffer(b"".join(table.column("parity").to_pylist()), np.uint64).reshape(-1, PARITY_WORDS)
        keys = [np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()]
        low, high, own = (np.frombuffer(b"".join(table.column(x).to_pylist()), np.uint32).astype(np.int64) for x in ("low", "high", "own"))
        row, key = np.repeat(np.arange(len(keys)), [len(k) for k in keys]), np.concatenate(keys)
        order = np.lexsort((row, high, low, key))
        row, key, low, high, own = row[order], key[order], low[order], high[order], own[order]
        new = np.ones(len(row), bool)
        new[1:] = (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(row)))
        found = [np.zeros(0, np.int64)]

        def test(a: np.ndarray, b: np.ndarray) -> None:
            """Keep the pairs of places (a, b) that may be links."""
            x, y = row[a], row[b]
            ok = comp[x] != comp[y]
            ok &= np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * percent
            ok &= (low[a] == high[a]) | (own[a] != own[b])  # of two blocks, pairs inside one are tested where it meets itself
            x, y = x[ok], y[ok]
            differ = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1, dtype=np.int64)
            least = needed(n[x], n[y], percent) - np.maximum(n[x] - prefix[x], n[y] - prefix[y])
            ok = c[x] + c[y] - differ >= 2 * least
            found.append(np.unique(np.minimum(x[ok], y[ok]) * len(keys) + np.maximum(x[ok], y[ok])))

        for k in np.unique(size[(size > 1) & (size <= FEW_NODES)]).tolist():  # small groups: all of one size together
            i, j = np.triu_indices(k, 1)
            starts = first[size == k]
            for at in range(0, len(starts), max(1, (1 << 19) // len(i))):
                some = starts[at : at + max(1, (1 << 19) // len(i))]
                test((some[:, None] + i[None, :]).ravel(), (some[:, None] + j[None, :]).ravel())
        for a, k in zip(first[size > FEW_NODES].tolist(), size[size > FEW_NODES].tolist(), strict=True):
            step = max(1, (1 << 19) // k)
            for at in range(0, k, step):
                i = np.arange(at, min(at + step, k))
                i, j = (z.ravel() for z in np.meshgrid(i, np.arange(at, k), indexing="ij"))
                test(a + i[i < j], a + j[i < j])
        pair = np.unique(np.concatenate(found))
        return pa.table({"u": pa.array(node[pair // len(keys)]), "v": pa.array(node[pair % len(keys)])})

    return run


#: Token groups up to this size are tested many at a time.
FEW_NODES = 64


def _bits_of(pairs: DataFrame) -> np.ndarray:
    """Fixed-size bit table of the nodes of pairs (a set bit may stand for other nodes too)."""
    places = pairs.select(F.explode(F.array("u", "v")).alias("node")).select((F.pmod("node", F.lit(NODE_BITS)) + 1).alias("p"))
    bits = places.groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m"))
    out = np.zeros(NODE_BITS // 8, np.uint8)
    for b, m in bits.collect():  # at most NODE_BITS / 32768 rows of 4 KB
        out[(b - 1) * 4096 : b * 4096] = np.frombuffer(m, np.uint8)
    return np.unpackbits(out, bitorder="little").astype(bool)


def _sets_of(bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = bits.value
        for block in flat.blocks(batches, size=BLOCK_BYTES, rows=BLOCK_ROWS):
            sets = Sets(block)
            rows = sets.distinct_rows()
            rows = rows[wanted[sets.node[rows] % NODE_BITS]]
            if len(rows):
                yield pa.record_batch([pa.array(sets.node[rows]), pa.array([pack7(sets.token[sets.first[r] : sets.first[r + 1]]) for r in rows], pa.binary())],
                                      ["node", "tokens"])

    return run


_LINK = "u long, v long, n int, m int, overlap int"


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            out = []
            for i in range(batch.num_rows):
                a, b = unpack7(left[i].as_py()), unpack7(right[i].as_py())
                both = np.concatenate([a, b])
                both.sort()
                same = int((both[1:] == both[:-1]).sum())
                if same >= needed(len(a), len(b), percent):
                    out.append((i, len(a), len(b), same))
            rows = pa.array([x[0] for x in out], pa.int64())
            yield pa.record_batch([batch.column("u").take(rows), batch.column("v").take(rows),
                                   *(pa.array([x[k] for x in out], pa.int32()) for k in (1, 2, 3))], ["u", "v", "n", "m", "overlap"])

    return run


def _links(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of nodes that reach the threshold, by their full sets."""
    bits = docs.sparkSession.sparkContext.broadcast(_bits_of(pairs))
    sets = docs.select("text").mapInArrow(_sets_of(bits), "node long, tokens binary").groupBy("node").agg(F.first("tokens").alias("tokens"))
    joined = pairs.select("u", "v").join(sets.select(F.col("node").alias("u"), F.col("tokens").alias("left")), "u")
    joined = joined.join(sets.select(F.col("node").alias("v"), F.col("tokens").alias("right")), "v")
    return joined.select("u", "v", "left", "right").mapInArrow(_verify(percent), _LINK)


class _Join:
    """Signatures and shared postings of one table, kept in the shared folder while it is worked on."""

    def __init__(self, docs: DataFrame, percent: int):
        spark = docs.sparkSession
        self.docs, self.percent = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), percent
        self.tables = Tables(spark, "ngram-join")
        hashed = self.docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
        signed = self.tables.write(hashed.mapInArrow(_signatures, _SIGNATURE), "signatures")
        self.rows = signed.where("slice IS NULL").select("doc_id", "text_hash", "node", "n")
        slices = signed.where("slice IS NOT NULL").select("slice", "counts").groupBy("slice").applyInArrow(_add_counts, "slice int, counts binary").collect()
        counts = np.zeros(BUCKETS)
        for s, x in slices:  # SLICES rows, 8 MB at most
            counts[s * (BUCKETS // SLICES) : (s + 1) * (BUCKETS // SLICES)] = flat.wide(x)
        self.parts = max(shuffle_partitions(spark), int(counts.sum() * 0.3) // GROUP_TOKENS)
        tables = spark.sparkContext.broadcast(_levels(counts))
        sent = self.docs.select("text").mapInArrow(_prefixes(tables, self.parts, percent), _POSTING)
        self.postings = self.tables.write(sent.groupBy("part").applyInArrow(_shared_tokens, _SHARED), "postings")

    def open_postings(self, postings: DataFrame, comps: DataFrame | None) -> DataFrame:
        """Postings that a link between components can share, with how many such tokens the node has (c), how many
        of them a link of the node shares at least, and how many nodes have the token (df)."""
        own = postings.select("token", "node", "n", "prefix").withColumn("component", F.col("node"))
        if comps is not None:
            own = own.drop("component").join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
        groups = own.groupBy("token").agg(F.count("*").alias("df"), F.min("component").alias("low"), F.max("component").alias("high"))
        own = own.join(groups.where("low < high").select("token", "df"), "token")
        # a partner has percent of n tokens or more, so it shares as many as the least multiplicity of that size, or the node's own
        own_k = F.col("prefix") - F.col("n") + F.ceil(F.lit(self.percent) * F.col("n") / 100)
        partner_k = F.greatest(F.lit(1), F.floor(F.ceil(F.lit(self.percent) * F.col("n") / 100) / LEAST_PART))
        nodes = own.groupBy("node").agg(F.count("*").alias("c"), F.first(F.least(own_k, partner_k)).cast("int").alias("least")).where("c >= least")
        return own.join(nodes, "node")

    def pivot_pairs(self, postings: DataFrame) -> DataFrame:
        """Each node with the pivot that it shares most tokens with (half of those required at least)."""
        chosen = postings.groupBy("token").agg(F.max(F.struct("c", "node", "n", "prefix")).alias("p")).select(
            "token", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n"), F.col("p.prefix").alias("pivot_prefix")
        )
        shared = postings.join(chosen, "token").where(F.col("node") != F.col("pivot")).where(_alike("n", "pivot_n", self.percent))
        shared = shared.groupBy("node", "pivot", "n", "prefix", "pivot_n", "pivot_prefix").agg(F.count("*").alias("c"))
        enough = shared.where(F.col("c") * 2 >= _required("n", "prefix", "pivot_n", "pivot_prefix", self.percent))
        return enough.groupBy(F.col("node").alias("u")).agg(F.max_by("pivot", F.struct("c", "pivot")).alias("v"))

    def other_pairs(self, postings: DataFrame, postings_count: int) -> DataFrame:
        """All pairs of nodes in different components that can share as many prefix tokens as a link must."""
        lists = [F.collect_list("token").alias("tokens"), F.collect_list("df").alias("dfs")]  # at most a prefix
        nodes = postings.groupBy("node", "n", "prefix", "component", "least").agg(*lists)
        # as many parts as the volume asks for: a pair is met in each part that holds one of its tokens
        parts = max(LEAST_PARTS, postings_count // PART_POSTINGS)
        rows = nodes.mapInArrow(_generators(parts), _LISTED_DDL)
        pairs = rows.groupBy("part").applyInArrow(_listed(self.percent), _PAIR)
        return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def similar_pairs(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """All links between distinct sets, and membership.

    Returns (links, members): links has u, v (nodes), n, m (set sizes) and
    overlap; members has doc_id, node and n for every document (node NULL: no words).
    """
    join = _Join(docs, percent)
    pairs = join.tables.write(join.other_pairs(join.open_postings(join.postings, None), join.postings.count()), "pairs")
    return _links(join.docs, pairs, percent), join.rows


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Each document's shingle count and the component of its links.

    Returns doc_id, n_shingles (long) and component_id: the smallest doc_id
    that links lead to, the document's own included. Two more columns tell rows
    apart that share a doc_id: text_hash (xxhash64 of the text) and node, a name of the component (NULL: no words).

    NULL, empty and blank texts have no shingles and are linked with nothing.
    Fewer than five words make one shingle of the whole sequence. Documents
    with equal sets, repeated rows included, are linked. A row whose doc_id is
    NULL takes part, but names no component unless nothing else is in it.
    Other columns are ignored; an empty table gives an empty result.
    """
    join = _Join(docs, percent)
    tables = join.tables
    postings = tables.write(join.open_postings(join.postings, None), "open_postings")
    tables.drop("postings")
    pairs = tables.write(join.pivot_pairs(postings), "pivot_pairs")
    links = tables.write(_links(join.docs, pairs, percent).select("u", "v"), "pivot_links")
    comps = tables.write(components(links), "pivot_components")
    pairs = tables.write(join.other_pairs(join.open_postings(postings, comps), postings.count()), "pairs")
    if not pairs.isEmpty():
        links = tables.write(links.unionByName(_links(join.docs, pairs, percent).select("u", "v")), "links")
        comps = tables.write(components(links), "components")
    nodes = join.rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    nodes = nodes.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = nodes.join(least, "component").select("node", "component_id", "component")
    done = join.rows.join(named, "node", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
        "text_hash", F.col("component").alias("node"),
    )
    done = done.checkpoint()
    tables.drop()
    return done
