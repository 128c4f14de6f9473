"""Exact self-join of documents by the Jaccard similarity of their word n-grams, over prefix trees.

1. Documents of equal sets are one class from the start.
2. A first sieve takes part of each set, in the order of the hashes: of two similar sets these parts share at least a
   certain number of n-grams, so a class whose part shares fewer with all others together is alone.
3. For the classes left, the n-grams that some other class has too are counted and put into one global order, rare ones
   first. A similar pair shares one of the first few: these tie the classes into groups that can be joined apart.
4. In each group the sets are stored in a trie, in which sets that begin alike share nodes. A set is compared with all
   stored ones by one traversal that carries the overlap so far and leaves out subtrees whose remaining length cannot
   reach the similarity.

n-grams that hold a large share of the rows are found in a fixed share of the sets and dealt out in parts, as it is known
without counting that several classes have them. Groups beyond a bound are split into parts, after their members have been compared with one leader: only what is not
similar to it has to meet all the others. Links inside one component are not all listed; no link between components is lost.
"""

from __future__ import annotations

import hashlib
import itertools
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.graph import components
from broadsheet.llm.rows import as_bytes, join_on_counted, slices
from broadsheet.session import durable

SHINGLE = 5
SIMILAR = 75  # percent; the bounds below are for this value or any other of 50 and more
SIEVE = 16  # the first sieve asks for a share of 1 / SIEVE of the set beyond the necessary prefix
GROUP_TOKENS = 1_000_000  # n-grams that one task holds in a trie
COMMON = 1 << 20  # n-grams of as many classes and more are ordered by hash
PROBE = 256  # one class in so many is looked at for hot n-grams
HOT_SHARE = 4096  # an n-gram with more than one in so many n-grams of those classes is hot; so many can be hot at the utmost
HOT_CLASSES = 16  # of those classes that have a hot n-gram, at least
SALTS = 256  # parts that the rows of a hot n-gram are dealt into
CHUNK = 32

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit of the argument reaches every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[0] = 1
    return np.multiply.accumulate(out)


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word n-grams of each text; a text of fewer words is one n-gram."""
    lowered = b"\n".join(t.lower() for t in texts) + b"\n"  # bytes: A-Z only
    data = np.frombuffer(lowered, np.uint8)
    lengths = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(lengths)
    space = _SPACE[data]
    inside = ~space
    begins = np.flatnonzero(inside & np.concatenate([[True], space[:-1]]))
    stops = np.flatnonzero(inside & np.concatenate([space[1:], [True]])) + 1
    # Words: a polynomial in their bytes, summed over bytes that stand at the same distance from the word's begin.
    words = np.zeros(len(begins), np.uint64)
    size = stops - begins
    for at in range(int(size.max(initial=0)) if len(size) and size.max() <= 64 else 0):
        if at % 8 == 0:
            longer = np.flatnonzero(size > at)
        live = longer[size[longer] > at]
        words[live] = (words[live] + data[begins[live] + at].astype(np.uint64) + np.uint64(1)) * _BASE
    if len(size) and size.max() > 64:
        powers = _powers(_BASE, int(size.max()) + 1)
        values = data.astype(np.uint64) + np.uint64(1)
        short = size <= 64
        for at in range(64):
            live = np.flatnonzero(short & (size > at))
            words[live] = (words[live] + values[begins[live] + at]) * _BASE
        for w in np.flatnonzero(~short):
            n = size[w]
            words[w] = (values[begins[w] : stops[w]] * powers[1 : n + 1][::-1]).sum()
    words = _mixed(words + size.astype(np.uint64))
    first = np.searchsorted(begins, np.concatenate([[0], ends[:-1]]))
    last = np.searchsorted(begins, ends)
    grams = _chain([words[j : len(words) - shingle + 1 + j] for j in range(shingle)]) if len(words) >= shingle else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a >= shingle:
            out.append(np.unique(grams[a : b - shingle + 1]))
        elif b > a:
            out.append(_chain([words[i : i + 1] for i in range(a, b)]) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _chain(parts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros_like(parts[0])
    for p in parts:
        out = _mixed(out * _BASE + p)
    return out


def least_overlap(n: int, similar: int = SIMILAR) -> int:
    """N-grams that a set of ``n`` shares at least with any similar one."""
    return -(-similar * n // 100)


def _class_hash(tokens: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def document_classes(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, n, h1, h2, probe)``: the size of each document's set, the hash of the set, and of one class in ``PROBE`` the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            sets = shingle_sets(as_bytes(piece.column(1)), shingle)
            hashes = [_class_hash(s) for s in sets]
            columns = [[len(s) for s in sets], [h[0] for h in hashes], [h[1] for h in hashes]]
            probe = pa.array([s.view(np.int64) if h[0] % PROBE == 0 else None for s, h in zip(sets, hashes, strict=True)], pa.list_(pa.int64()))
            arrays = [piece.column(0), *(pa.array(c, pa.int64()) for c in columns), probe]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "h1", "h2", "probe"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n bigint, h1 bigint, h2 bigint, probe array<bigint>")


def _hot(classes: DataFrame) -> DataFrame:
    """``(token, hot)``: at most ``HOT_SHARE`` n-grams that many of the probed classes have."""
    probed = classes.where("probe IS NOT NULL")
    total = probed.agg(F.coalesce(F.sum(F.size("probe")), F.lit(0))).first()[0]
    counts = probed.select(F.explode("probe").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    return durable(counts.where((F.col("n") >= HOT_CLASSES) & (F.col("n") * HOT_SHARE > total)).select("token", F.lit(True).alias("hot")))


def _dealt(rows: DataFrame, hot: DataFrame, owner: str) -> DataFrame:
    """``(token, owner, hot)`` with the rows of an n-gram in one task, those of a hot one in parts by owner, in this order."""
    marked = rows.join(F.broadcast(hot), "token", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    part = F.when(F.col("hot"), F.pmod(F.xxhash64(owner), F.lit(SALTS))).otherwise(F.lit(0))
    return marked.select("token", owner, "hot").repartition("token", part).sortWithinPartitions("token", owner)


def _sieve_parts(docs: DataFrame, shingle: int, similar: int) -> DataFrame:
    """``(token, h1)``: of each set the necessary prefix and ``n // SIEVE`` more, a class at most once per task and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for piece in slices(batches):
            tokens, owners = [], []
            for s in shingle_sets(as_bytes(piece.column(0)), shingle):
                n = len(s)
                if not n or (h := _class_hash(s)[0]) in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(h)
                part = s[: n - least_overlap(n, similar) + max(1, n // SIEVE)]
                tokens.append(part)
                owners.append(np.full(len(part), h, np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(owners))], names=["token", "h1"])

    return docs.select("text").mapInArrow(run, "token bigint, h1 bigint")


def _shared_counts(parts: DataFrame, hot: DataFrame) -> DataFrame:
    """``(h1, shared)``: how many n-grams of a class's part are hot or some other class has in its part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted by n-gram and class. A row is shared when its n-gram has another class; that of the first class of an
        # n-gram waits until a second one comes, which may be in the next batch. Hot ones need no second one.
        token, head, told = None, None, True
        last = None
        for batch in batches:
            t, o = (np.asarray(c) for c in batch.columns[:2])
            hot = batch.column(2).to_numpy(zero_copy_only=False)
            if not len(t):
                continue
            new = np.concatenate([[token is None or t[0] != token], t[1:] != t[:-1]])
            again = ~new & np.concatenate([[last == o[0]], o[1:] == o[:-1]])
            run_of = np.cumsum(new) - 1  # -1: goes on from the batch before
            firsts = o[np.flatnonzero(new)]
            head_of = np.where(run_of < 0, head if head is not None else 0, firsts[np.maximum(run_of, 0)] if len(firsts) else 0)
            other = ~new & ~again & (o != head_of) & ~hot
            shared = [o[other], o[hot & ~again]]
            runs = np.unique(run_of[other])
            if len(runs) and runs[0] < 0:
                if not told:
                    shared.append(np.array([head]))
                told = True
                runs = runs[1:]
            shared.append(firsts[runs] if len(runs) else np.zeros(0, np.int64))
            if len(firsts):
                head, told = firsts[-1], bool(len(runs)) and runs[-1] == len(firsts) - 1
            token, last = t[-1], o[-1]
            owners, counts = np.unique(np.concatenate(shared), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(owners.astype(np.int64)), pa.array(counts.astype(np.int64))], names=["h1", "shared"])

    return _dealt(parts, hot, "h1").mapInArrow(run, "h1 bigint, shared bigint").groupBy("h1").agg(F.sum("shared").alias("shared"))


def _tokens_of(docs: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """``(token, id)`` of every class in ``classes``, from the text of its smallest document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            tokens, owners = [], []
            wanted = zip(piece.column(1).to_pylist(), piece.column(2).to_pylist(), piece.column(3).to_pylist(), strict=True)
            for s, (id_, h1, h2) in zip(shingle_sets(as_bytes(piece.column(0)), shingle), wanted, strict=True):
                if _class_hash(s) == (h1, h2):  # another row may have the same doc_id
                    tokens.append(s)
                    owners.append(np.full(len(s), id_, np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(owners))], names=["token", "id"])

    texts = docs.select("doc_id", "text").join(classes.select(F.col("min_doc").alias("doc_id"), "id", "h1", "h2"), "doc_id")
    return texts.select("text", "id", "h1", "h2").mapInArrow(run, "token bigint, id bigint")


def _frequencies(tokens: DataFrame, hot: DataFrame) -> DataFrame:
    """``(id, df, token)`` for n-grams of two or more classes, each class once; ``df`` ends at ``COMMON``, that of hot ones is it."""

    def flush(token: int, ids: list[int], df: int, out: list) -> None:
        out[0].append(np.array(ids, np.int64))
        out[1].append(np.full(len(ids), df, np.int32))
        out[2].append(np.full(len(ids), token, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, held, common = None, [], False
        for batch in batches:
            t, o = (np.asarray(c) for c in batch.columns[:2])
            hot = batch.column(2).to_numpy(zero_copy_only=False)
            if not len(t):
                continue
            out: list[list] = [[], [], []]
            cuts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])).tolist() + [len(t)]
            sizes = np.diff(cuts)
            for a, n in zip(cuts[:-1], sizes.tolist(), strict=True):
                if t[a] != token:
                    if not common and len(held) > 1:
                        flush(token, held, len(held), out)
                    token, held, common = t[a], [], False
                if n == 1 and (not held or held[-1] != o[a]):
                    held.append(int(o[a]))
                elif n > 1:
                    ids = o[a : a + n]
                    fresh = np.concatenate([[not held or held[-1] != ids[0]], ids[1:] != ids[:-1]])
                    held.extend(ids[fresh].tolist())
                if len(held) >= COMMON or (len(held) > 1 if common else hot[a]):
                    # The last id stays, to be told from its repetition; it has been given out already.
                    flush(token, held[1:] if common else held, COMMON, out)
                    held, common = held[-1:], True
            yield _frequency_batch(out)
        if not common and len(held) > 1:
            out = [[], [], []]
            flush(token, held, len(held), out)
            yield _frequency_batch(out)

    return _dealt(tokens, hot, "id").mapInArrow(run, "id bigint, df int, token bigint")


def _frequency_batch(out: list[list]) -> pa.RecordBatch:
    kinds = (np.int64, np.int32, np.int64)
    arrays = [pa.array(np.concatenate(x) if x else np.zeros(0, k)) for x, k in zip(out, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["id", "df", "token"])


class Trie:
    """Sets of numbers in increasing order; sets that begin alike share nodes. Knows which sets are already linked."""

    __slots__ = ("similar", "root", "parent")

    class Node:
        __slots__ = ("tokens", "chunks", "children", "sets", "low", "high", "rest", "roots")

        def __init__(self, tokens: list[int]):
            self.tokens, self.children, self.sets = tokens, {}, []
            self.low, self.high, self.rest, self.roots = 1 << 60, 0, 0, set()
            self.cut()

        def cut(self) -> None:
            t = self.tokens
            self.chunks = [(frozenset(t[i : i + CHUNK]), t[min(i + CHUNK, len(t)) - 1], len(t) - min(i + CHUNK, len(t))) for i in range(0, len(t), CHUNK)]

    def __init__(self, similar: int):
        self.similar, self.root, self.parent = similar, Trie.Node([]), {}

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def add(self, key: int, tokens: list[int], n: int) -> list[int]:
        """Links ``key`` with what is stored and stores it. Returns the keys that newly came into its component.

        ``n`` is the size of the whole set, of which ``tokens`` are the members that others can have.
        """
        self.parent[key] = key
        linked = self._probe(key, tokens, n)
        self._insert(key, tokens, n)
        return linked

    def _probe(self, key: int, tokens: list[int], n: int) -> list[int]:
        own, size, similar, linked = frozenset(tokens), len(tokens), self.similar, []
        low, high = -(-similar * n // 100), 100 * n // similar
        stack = [(self.root, 0)]
        while stack:
            node, overlap = stack.pop()
            if node.high < low or node.low > high:
                continue
            if node.roots is not None:
                mine = self.find(key)
                if all(self.find(r) == mine for r in node.roots):
                    continue
            need = -(-similar * (n + max(low, node.low)) // (100 + similar))
            alive = True
            for chunk, last, left in node.chunks:
                overlap += len(chunk & own)
                if overlap + min(left + node.rest, size - bisect_right(tokens, last)) < need:
                    alive = False
                    break
            if not alive:
                continue
            for other, m in node.sets:
                if 100 * overlap >= similar * (n + m - overlap):
                    a, b = self.find(key), self.find(other)
                    if a != b:
                        self.parent[b] = a
                        linked.append(other)
            stack.extend((child, overlap) for child in node.children.values())
        return linked

    def _insert(self, key: int, tokens: list[int], n: int) -> None:
        node, at, root = self.root, 0, self.find(key)
        while True:
            shared, limit = 0, min(len(node.tokens), len(tokens) - at)
            while shared < limit and node.tokens[shared] == tokens[at + shared]:
                shared += 1
            if shared < len(node.tokens):
                self._split(node, shared)
            at += shared
            node.low, node.high, node.rest = min(node.low, n), max(node.high, n), max(node.rest, len(tokens) - at)
            if node.roots is not None and root not in node.roots:
                node.roots = {self.find(r) for r in node.roots} | {root}
                if len(node.roots) > 4:
                    node.roots = None
            if at == len(tokens):
                node.sets.append((key, n))
                return
            if tokens[at] not in node.children:
                node.children[tokens[at]] = Trie.Node(tokens[at:])
            node = node.children[tokens[at]]

    @staticmethod
    def _split(node: Trie.Node, at: int) -> None:
        lower = Trie.Node(node.tokens[at:])
        lower.children, lower.sets, lower.low, lower.high, lower.rest = node.children, node.sets, node.low, node.high, node.rest
        lower.roots = None if node.roots is None else set(node.roots)
        node.rest += len(lower.tokens)
        node.tokens, node.children, node.sets = node.tokens[:at], {lower.tokens[0]: lower}, []
        node.cut()


def join_group(members: list[tuple[int, int, list[int]]], similar: int = SIMILAR) -> list[tuple[int, int]]:
    """Links that span the components of one group of ``(id, n, n-grams)``, found over a trie.

    In the trie the n-grams of many members come first, so that members share long paths.
    """
    counts = Counter(itertools.chain.from_iterable(m[2] for m in members))
    rank = {t: i for i, t in enumerate(sorted(counts, key=lambda t: (-counts[t], t)))}
    trie, links = Trie(similar), []
    for key, n, tokens in members:
        links += [(key, other) for other in trie.add(key, sorted(rank[t] for t in tokens), n)]
    return links


def _join_blocks(blocks: DataFrame, similar: int) -> DataFrame:
    """``(a, b)`` links from rows ``(comp, i, j, id, n, tokens)``, each ``(comp, i, j)`` joined by itself."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for piece in slices(iter([batch]), 256):
                yield from zip(*(c.to_pylist() for c in piece.columns), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in itertools.groupby(rows(batches), key=lambda r: r[:3]):
            links = join_group([(r[3], r[4], r[5]) for r in group], similar)
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])

    ordered = blocks.select("comp", "i", "j", "id", "n", "tokens").repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j", "id")
    return ordered.mapInArrow(run, "a bigint, b bigint")


def _links(sets: DataFrame, similar: int, group_tokens: int) -> DataFrame:
    """``(a, b)``: links that span the components of ``(id, n, tokens)`` rows, n-grams in their global order."""
    prefix = F.slice("tokens", 1, (F.size("tokens") - F.ceil(F.col("n") * similar / 100) + 1).cast("int"))
    postings = durable(sets.select("id", F.explode(prefix).alias("token")))
    heads = postings.groupBy("token").agg(F.min("id").alias("head"), F.count("*").alias("n_ids")).where("n_ids > 1")
    edges = join_on_counted(postings, heads, ["token"], "n_ids").where("id <> head").select(F.col("id").alias("a"), F.col("head").alias("b"))
    comps = durable(components(edges))
    sized = durable(sets.join(comps, "id"))
    weights = sized.groupBy("comp").agg(F.sum(F.size("tokens")).alias("weight"), F.count("*").alias("n_ids"), F.min("id").alias("leader"))
    members = durable(join_on_counted(sized, weights, ["comp"], "n_ids").drop("n_ids"))
    half = max(1, group_tokens // 2)
    small = members.where(F.col("weight") <= group_tokens).select("comp", F.lit(0).alias("i"), F.lit(0).alias("j"), "id", "n", "tokens")
    # Large groups: everything meets the leader first, dealt out by id.
    parts = F.ceil(F.col("weight") / half).cast("int")
    large = members.where(F.col("weight") > group_tokens).withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
    leaders = large.where("id = leader").select(
        "comp", F.col("n").alias("lead_n"), F.col("tokens").alias("lead_tokens"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")
    )
    overlap = F.size(F.array_intersect("tokens", "lead_tokens"))
    met = durable(
        large.join(leaders, ["comp", "part"]).withColumn("near", 100 * overlap >= similar * (F.col("n") + F.col("lead_n") - overlap)).drop("lead_tokens", "lead_n", "part")
    )
    stars = met.where("near AND id <> leader").select(F.col("id").alias("a"), F.col("leader").alias("b"))
    # What is near the leader is one component; the others meet all members, part against part.
    far = met.groupBy("comp").agg(
        F.ceil(F.sum(F.when(~F.col("near"), F.size("tokens")).otherwise(0)) / half).cast("int").alias("n_far"),
        F.ceil(F.sum(F.when(F.col("near"), F.size("tokens")).otherwise(0)) / half).cast("int").alias("n_near"),
        F.count("*").alias("n_ids"),
    )
    placed = join_on_counted(met, far, ["comp"], "n_ids").where("n_far > 0")
    spread = F.xxhash64("id", F.lit(1))
    own = F.when(F.col("near"), F.col("n_far") + F.pmod(spread, F.greatest("n_near", F.lit(1)))).otherwise(F.pmod(spread, F.greatest("n_far", F.lit(1)))).cast("int")
    placed = placed.withColumn("own", own)
    last = F.when(F.col("near"), F.col("n_far") - 1).otherwise(F.col("n_far") + F.col("n_near") - 1)
    meets = placed.withColumn("with", F.explode(F.sequence(F.lit(0), last)))
    split = meets.select("comp", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "id", "n", "tokens")
    return _join_blocks(small.unionByName(split), similar).unionByName(stars)


def similar_components(
    docs: DataFrame, shingle: int = SHINGLE, similar: int = SIMILAR, group_tokens: int = GROUP_TOKENS
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``.

    Two documents are linked when the Jaccard similarity of their sets of distinct word n-grams is at least ``similar``
    percent (whole-number arithmetic); ``component_id`` is the smallest ``doc_id`` that links reach, the document itself
    included. Fewer words than ``shingle`` are one n-gram; null, empty and blank texts have none and are linked with
    nothing. Rows of equal ids are documents of their own that share the id. Rows without id get a null component and
    link nothing. n-grams are compared by 64-bit hashes.
    """
    classes = durable(document_classes(docs, shingle))
    usable = classes.where("n > 0 AND doc_id IS NOT NULL")
    reps = usable.groupBy("h1", "h2").agg(F.min("doc_id").alias("min_doc"), F.first("n").alias("n"), F.first("probe").alias("probe"))
    reps = durable(reps.withColumn("id", F.monotonically_increasing_id()))
    named = docs.where("doc_id IS NOT NULL")
    counts = _shared_counts(_sieve_parts(named, shingle, similar), _hot(reps))
    need = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * similar / 100) / SIEVE))
    left = durable(reps.join(counts, "h1").where(F.col("shared") >= need).select("id", "min_doc", "n", "h1", "h2", "probe"))
    shared = _frequencies(_tokens_of(named, left, shingle), _hot(left))
    grouped = shared.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("x"))
    sets = durable(
        grouped.where(F.size("x") >= 1).join(left.select("id", "n"), "id")
        .where(F.size("x") >= F.ceil(F.col("n") * similar / 100)).select("id", "n", F.col("x.token").alias("tokens"))
    )
    comps = components(_links(sets, similar, group_tokens))
    merged = durable(reps.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id")))
    smallest = merged.groupBy("comp").agg(F.min("min_doc").alias("component_id"), F.count("*").alias("n_ids"))
    class_of = join_on_counted(merged, smallest, ["comp"], "n_ids").select("h1", "h2", "component_id")
    sizes = usable.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"))
    linked = join_on_counted(usable, class_of.join(sizes, ["h1", "h2"]), ["h1", "h2"], "n_docs")
    alone = classes.where("n = 0 OR doc_id IS NULL").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    return linked.select(*columns).unionByName(alone.select(*columns))
