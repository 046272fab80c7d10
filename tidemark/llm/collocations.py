"""Phrase collocations by dynamic itemset counting.

Documents are turned once into blocks of word numbers, dealt into ``SHARDS`` files of equal parts, which are then
scanned in a cycle, one a step. Single words are counted from the first step on. A phrase of k words becomes active in
the step after both of its subphrases of k - 1 words reached the threshold, stays active for exactly one full cycle,
wherever in the cycle it began, and is then completely counted, so lengths interleave in the scans and no length waits
for a shorter one.

What a scan has to know is the step in which each subphrase reached the threshold. It is kept by hash slot: a table
of ``2 ** bits`` bytes for each length, at most ``MOST_BITS``, on the driver; two bits of each travel to tasks. A slot
that several phrases share reaches the threshold with the first of them. That may make a phrase
active that need not be, or earlier, but it is active for one full cycle all the same, so no phrase is missed
whatever the size of the table; a table too small for the corpus costs time and disk, not results.

A task adds up the active phrases of its blocks, about ``HELD_PRINTS`` at a time, and sends each hash shard that gets any
the phrases' fingerprints with their counts. A phrase costs that one entry, however often it occurs, so frequent words,
lines and passages make no hot shard. After each step the shards add up what came, report the slots that reached the
threshold, and keep the sums of the fingerprints in all other slots for the next step. What a slot holds is not sent
again once it has reached the threshold: it is then only to be counted as text. That is done after the last step, when
one more scan counts, as strings and exactly, the phrases whose slot reached it: every phrase that occurs often enough
is among them, since its fingerprint was counted over a whole cycle or until it reached the threshold, and what only
shared a fingerprint or a slot falls out.

Cuts, scores and the removal of phrases inside longer ones are DataFrame joins and aggregates over the phrases that
reach the threshold; scores are exact decimals of 38 digits (counts below 10^16).

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows count as often as they
stand; other columns are ignored; a phrase never crosses a row or a piece.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm import blocks as B, ngrams as N, textops as X
from tidemark.session import discard, scratch_path, settle

SHARDS = 2
LONGEST = 3
LEAST = 10
INSIDE_PERCENT = 50
TOP = 2000
SLICE = 3 << 20
SHARD_TEXT = 12 << 20
MOST_BITS = 26
NEVER = 255
LANE = 100_000
HELD = 1_000_000
HELD_PRINTS = 2_000_000
BREAK = X.byte_table([(c, c) for c in b".,;:!?"] + [(0x0A, 0x0D)])
WORD = ~(BREAK | X.byte_table([(0x20, 0x20), (0x09, 0x09)]))
DEALT = "dealt int, bytes long, words binary, codes binary, links binary"
PRINTED = "k int, shard long, prints binary, counts binary"
SUMMED = f"{PRINTED}, slots binary"
COUNTED = "k int, shard long, payload binary"
REACHED = "k int, slots binary"
FOUND = "lang string, k int, phrase string, f long"


class Steps:
    """For each length the step in which a slot's phrases reached the threshold, or NEVER."""

    def __init__(self, bits: int, longest: int):
        self.bits, self.at = bits, {k: np.full(1 << bits, NEVER, np.uint8) for k in range(1, longest + 1)}

    def active(self, k: int, step: int, cycle: int) -> bool:
        if k == 1:
            return step < cycle
        at = self.at[k - 1]
        return bool(((at < step) & (at >= max(0, step - cycle))).any())

    def packed(self, step: int, cycle: int) -> dict[int, list[bytes]]:
        """For each length a bit for every slot that has reached the threshold, and for every one that did so more than a
        cycle before the step."""
        bits = lambda found: zstandard.ZstdCompressor(level=1).compress(np.packbits(found, bitorder="little").tobytes())
        return {k: [bits(at != NEVER), bits(at < max(0, step - cycle))] for k, at in self.at.items()}


def slots(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> X.U64(64 - bits)).astype(np.int64)


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> X.U64(32)) * X.U64(shards) >> X.U64(32)).astype(np.int64)


def _tail(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of phrases with one more word at their ends."""
    return X.mix(h * X.U64(0x9E3779B97F4A7C15) + word, 3)


def encode(part: pa.RecordBatch) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """A slice of (lang, text) rows as its distinct words of languages, ordered by word, the number of each word in
    reading order, and whether the next word follows it in the same piece."""
    data, bounds = X.text_bytes(part.column(1))
    data = X.LOWER[data]
    starts, ends, rows = X.word_spans(data, bounds, WORD)
    n = len(starts)
    offsets = np.zeros(n + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    body = np.ascontiguousarray(data[WORD[data]])
    words = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(offsets), pa.py_buffer(body)]).dictionary_encode()
    langs = part.column(0).dictionary_encode()
    place = np.empty(len(words.dictionary), np.int64)
    place[pc.sort_indices(words.dictionary).to_numpy()] = np.arange(len(place))
    owner = np.repeat(langs.indices.to_numpy(), np.diff(rows)).astype(np.int64)
    code, pairs = pd.factorize(place[words.indices.to_numpy()] * max(1, len(langs.dictionary)) + owner)
    order = np.argsort(pairs)
    rank = np.empty(len(pairs), np.int32)
    rank[order] = np.arange(len(pairs), dtype=np.int32)
    word, lang = np.divmod(pairs[order], max(1, len(langs.dictionary)))
    known = pa.table({
        "lang": langs.dictionary.take(pa.array(lang)),
        "word": words.dictionary.take(pa.array(np.argsort(place)[word])),
    })
    pieces = np.zeros(len(data) + 1, np.int32)
    np.cumsum(BREAK[data], out=pieces[1:], dtype=np.int32)
    linked = np.zeros(n, bool)
    linked[:-1] = pieces[starts[1:]] == pieces[starts[:-1]]
    linked[rows[1:][rows[1:] > 0] - 1] = False
    return known, rank[code], linked


def _set(bitmap: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def phrases(known: pa.Table, code: np.ndarray, linked: np.ndarray, lengths: set[int], found: bool, told: dict[int, list[np.ndarray]],
            bits: int):
    """Of a block, for each length, the active phrases whose slot has not reached the threshold yet (``found``: those whose
    slot has): hashes, counts, the place of an occurrence (of a word: its number)."""
    n = len(code)
    if not n:
        return
    word = known.column("word").combine_chunks()
    langs = known.column("lang").combine_chunks().dictionary_encode()
    spoken = np.array([xxhash.xxh64_intdigest(x) for x in langs.dictionary.to_pylist()], X.U64)[langs.indices.to_numpy()]
    _, spots, raw = word.buffers()
    spots = np.frombuffer(spots, np.int64)[word.offset : word.offset + len(word) + 1]
    single = X.mix(X.word_hashes(np.frombuffer(raw, np.uint8), spots[:-1], spots[1:]) ^ spoken)
    if 1 in lengths:
        n_of = np.bincount(code, minlength=len(word))
        some = np.flatnonzero(_set(told[1][0], slots(single, bits)) == found)
        yield 1, single[some], n_of[some], some
    code = code.astype(np.int64)
    begins, whole = np.arange(n), np.ones(n, bool)  # where phrases of length k may begin; whether any does
    reach, over = (_set(x, slots(single, bits))[code] for x in told[1])
    h = single[code]
    for k in range(2, max(lengths) + 1):
        whole = whole & np.append(whole[1:], False) & linked
        active = reach & np.append(reach[1:], False) & ~(over & np.append(over[1:], False))
        h = _tail(h, np.append(single[code[k - 1 :]], np.zeros(k - 1, X.U64)))
        reach, over = (whole & _set(x, slots(h, bits)) for x in told[k])
        chosen = begins[reach if found else whole & active & ~reach]
        if k in lengths and len(chosen):
            key = code[chosen]
            for j in range(1, k):  # numbers of the phrases, word by word
                key = (pd.factorize(key)[0].astype(np.int64) if j > 1 else key) << 32 | code[chosen + j]
            number, distinct = pd.factorize(key)
            count = np.bincount(number, minlength=len(distinct))
            one = np.zeros(len(distinct), np.int64)
            one[number[::-1]] = chosen[::-1]
            yield k, h[one], count, one


def texts(known: pa.Table, code: np.ndarray, k: int, one: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Languages and texts of phrases of k words."""
    word = known.column("word").combine_chunks()
    if k == 1:
        return known.column("lang").combine_chunks().take(pa.array(one)), word.take(pa.array(one))
    parts = [word.take(pa.array(code[one + j])) for j in range(k)]
    return known.column("lang").combine_chunks().take(pa.array(code[one])), pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))


def _opened(batches):
    for batch in batches:
        for words, codes, links in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            code = B.unsqueeze(codes, np.int32).astype(np.int64)
            linked = np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(links), np.uint8), count=len(code)).astype(bool)
            yield B.unpack(words), code, linked


def _unpacked(told) -> dict[int, list[np.ndarray]]:
    return {k: [np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8) for x in v] for k, v in told.value.items()}


def _rows(rows, schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[t]) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def scan(blocks: DataFrame, lengths: set[int], step: int, cycle: int, steps: Steps, shards: int, width: int) -> DataFrame:
    """One step: fingerprints of ``width`` bits with the counts of all active phrases of one shard of the documents."""
    told, bits = blocks.sparkSession.sparkContext.broadcast(steps.packed(step, cycle)), steps.bits
    lost = X.U64(64 - width)

    def count(batches):
        at, held, size = _unpacked(told), {}, 0
        for known, code, linked in _opened(batches):
            for k, h, n, _ in phrases(known, code, linked, lengths, False, at, bits):
                held.setdefault(k, []).append((h >> lost, n.astype(np.uint32)))
                size += len(h)
            if size > HELD_PRINTS:
                yield from sent(held)
                held, size = {}, 0
        yield from sent(held)

    def sent(held):
        for k in sorted(held):
            prints, n = N.summed(*(np.concatenate(x) for x in zip(*held.pop(k))))
            edges = np.searchsorted(shard_of(prints << lost, shards), np.arange(shards + 1))  # shards are ranges of hashes
            yield _rows([
                (k, s, *_squeezed(prints[a:b], n[a:b])) for s, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())) if b > a
            ], PRINTED)

    return blocks.select("words", "codes", "links").mapInArrow(count, PRINTED)


def _squeezed(prints: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes]:
    return B.squeeze(np.diff(prints, prepend=X.U64(0))), B.squeeze(n.astype(np.uint32))


def named(blocks: DataFrame, longest: int, steps: Steps, shards: int) -> DataFrame:
    """The last scan: texts and counts of the phrases whose slot reached the threshold, and as k = 0 the words of each
    language. A task adds up what its blocks have, about ``HELD`` phrases at a time, before it sends it."""
    told, bits = blocks.sparkSession.sparkContext.broadcast(steps.packed(0, 0)), steps.bits

    def count(batches):
        at, held, size, words = _unpacked(told), {}, 0, Counter()
        for known, code, linked in _opened(batches):
            for k, h, n, one in phrases(known, code, linked, set(range(1, longest + 1)), True, at, bits):
                lang, phrase = texts(known, code, k, one)
                held.setdefault(k, []).append(pa.table({"lang": lang, "phrase": phrase, "c": pa.array(n.astype(np.int64)), "h": pa.array(h)}))
                size += len(h)
            langs = known.column("lang").combine_chunks().dictionary_encode()
            for name, n in zip(langs.dictionary.to_pylist(), np.bincount(langs.indices.to_numpy()[code], minlength=len(langs.dictionary)).tolist()):
                words[name] += n
            if size > HELD:
                yield from sent(held)
                held, size = {}, 0
        yield from sent(held)
        if words:
            names = sorted(words)
            whole = pa.table({"lang": names, "phrase": pa.nulls(len(names), pa.large_string()), "c": [words[x] for x in names]})
            yield _rows([(0, TaskContext.get().partitionId() % shards, B.pack(whole))], COUNTED)

    def sent(held):
        for k, parts in sorted(held.items()):
            whole = pa.concat_tables(parts)
            lang, text, n, first = totals(whole)
            order, edges = B.shard_runs(shard_of(whole.column("h").to_numpy()[first], shards), shards)
            whole = pa.table({"lang": lang, "phrase": text, "c": pa.array(n)}).take(pa.array(order))
            yield _rows([
                (k, s, B.pack(whole.slice(a, b - a).sort_by("phrase").combine_chunks()))
                for s, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())) if b > a
            ], COUNTED)

    return blocks.select("words", "codes", "links").mapInArrow(count, COUNTED)


def totals(whole: pa.Table) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """The distinct (lang, phrase) rows of a table with the sums of their counts, and the place of one of each."""
    texts, langs = (whole.column(c).combine_chunks().fill_null("").dictionary_encode() for c in ("phrase", "lang"))
    width = max(1, len(langs.dictionary))
    number, pairs = pd.factorize(texts.indices.to_numpy().astype(np.int64) * width + langs.indices.to_numpy())
    f = np.bincount(number, whole.column("c").to_numpy(), minlength=len(pairs)).astype(np.int64)  # exact below 2^53
    first = np.zeros(len(pairs), np.int64)
    first[number[::-1]] = np.arange(len(number))[::-1]
    text, lang = np.divmod(pairs, width)
    return langs.dictionary.take(pa.array(lang)), texts.dictionary.take(pa.array(text)), f, first


def summed(messages: DataFrame, bits: int, least: int, width: int) -> DataFrame:
    """Messages added up by length and shard: the slots with a phrase that occurs ``least`` times or more, and the
    fingerprints in other slots with their counts, as another message."""

    def total(key, table):
        prints = [np.cumsum(B.unsqueeze(x, X.U64), dtype=X.U64) for x in table.column("prints").to_pylist()]
        counts = [B.unsqueeze(x, np.uint32).astype(np.int64) for x in table.column("counts").to_pylist()]
        prints, counts = N.summed(np.concatenate(prints), np.concatenate(counts))
        slot = slots(prints << X.U64(64 - width), bits)
        hit = np.unique(slot[counts >= least])
        left = ~np.isin(slot, hit)
        row = (key[0].as_py(), key[1].as_py(), *_squeezed(prints[left], counts[left]), B.squeeze(hit.astype(np.uint32)))
        return pa.Table.from_batches([_rows([row], SUMMED)])

    return messages.groupBy("k", "shard").applyInArrow(total, SUMMED)


def reached(sums: DataFrame, bits: int, shards: int) -> list:
    """(k, slots) rows, a few of each length: the slots that reached the threshold."""

    def both(key, table):
        bitmap = np.zeros(1 << bits, bool)
        for raw in table.column("slots").to_pylist():
            bitmap[B.unsqueeze(raw, np.uint32)] = True
        return pa.table([pa.array([key[1].as_py()], pa.int64()), pa.array([key[0].as_py()], pa.int32()), pa.array([B.squeeze(np.flatnonzero(bitmap).astype(np.uint32))], pa.binary())],
                        names=["shard", "k", "slots"])

    hits = sums.select("k", "shard", "slots")
    for width in (shards // 512, 8):  # unions of bounded numbers of shards, then a few for the driver
        if width >= 8:
            hits = hits.withColumn("lane", F.col("shard") % width).groupBy("k", "lane").applyInArrow(both, f"shard long, {REACHED}")
    return hits.select("k", "slots").collect()


def added(messages: DataFrame, least: int) -> DataFrame:
    """Messages summed: (lang, k, phrase, f) with f >= ``least``, and rows with k = 0 for the words of a language."""

    def total(key, table):
        k = key[0].as_py()
        parts = [B.unpack(x) for x in table.column("payload").to_pylist()]
        lang, text, f, _ = totals(pa.concat_tables([p.set_column(0, "lang", p.column("lang").cast(pa.string())) for p in parts]))
        found = pa.table(
            [lang, pa.array(np.full(len(f), k, np.int32)), text.cast(pa.string()), pa.array(f)], names=["lang", "k", "phrase", "f"]
        )
        return found.filter(pa.array(f >= (least if k else 1)))

    return messages.groupBy("k", "shard").applyInArrow(total, FOUND)


def dealt(docs: DataFrame, lang: str, text: str, shards: int, path: str) -> list[DataFrame]:
    """The documents as blocks of word numbers, written once and dealt in turn to the shards."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))

    def blocks(batches):
        turn = TaskContext.get().partitionId()
        for batch in batches:
            for part in X.slices(batch, "text", SLICE):
                known, code, linked = encode(part)
                links = zstandard.ZstdCompressor().compress(np.packbits(linked).tobytes())
                size = int(X.text_bytes(part.column(1))[1][-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([turn % shards], pa.int32()), pa.array([size], pa.int64()),
                     *[pa.array([x], pa.binary()) for x in (B.pack(known.combine_chunks()), B.squeeze(code), links)]],
                    names=["dealt", "bytes", "words", "codes", "links"],
                )
                turn += 1

    rows.where("text <> ''").mapInArrow(blocks, DEALT).write.partitionBy("dealt").parquet(path)
    table = docs.sparkSession.read.schema("bytes long, words binary, codes binary, links binary, dealt int").parquet(path)
    return [table.where(F.col("dealt") == s) for s in range(shards)]


def count(docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = LONGEST, least: int = LEAST,
          cycle: int = SHARDS, bits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, f) of all phrases of up to ``longest`` words that occur ``least`` times or more, and (lang, n), all
    words of each language."""
    spark = docs.sparkSession
    scratch = scratch_path(spark, "collocation-shards")
    parts = dealt(docs, lang, text, cycle, scratch)
    total = sum(p.agg(F.sum("bytes")).first()[0] or 0 for p in parts)
    shards = B.counts(total, SHARD_TEXT)
    steps = Steps(bits or min(MOST_BITS, max(12, total.bit_length() - 5)), longest)
    width = min(63, max(40, total.bit_length() + 8))
    sums, path, step = None, None, 0
    while lengths := {k for k in range(1, longest + 1) if steps.active(k, step, cycle)}:
        before, path = path, scratch_path(spark, f"collocations-{step}")
        messages = scan(parts[step % cycle], lengths, step, cycle, steps, shards, width)
        if before:
            messages = sums.where(F.col("k").isin(list(lengths))).drop("slots").unionByName(messages)
        sums = settle(summed(messages, steps.bits, least, width), "collocations", path)
        if before:
            discard(spark, before)
        for k, hit in reached(sums, steps.bits, shards):
            hit = B.unsqueeze(hit, np.uint32)
            steps.at[k][hit[steps.at[k][hit] == NEVER]] = step
        step += 1
    discard(spark, path)
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    found = settle(added(named(every, longest, steps, shards), least), "collocation-counts")
    discard(spark, scratch)
    n = found.where("k = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return found.where("k > 0"), n


def scored(found: DataFrame) -> DataFrame:
    """(lang, phrase, k, a, l, r, score) of phrases of two words and more: the cut with the lowest score, ties to the
    shortest first part. Both parts of a cut reach the threshold because the phrase does."""
    split = F.split("phrase", " ")
    cuts = found.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), split.alias("w"))
    cuts = cuts.select("lang", "phrase", "k", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "k", "a", "cut", F.array_join(F.slice("w", 1, F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("right"),
    )
    left = found.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = found.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    exact = F.expr("(1000000BD * cast(a AS decimal(16, 0)) * cast(a AS decimal(16, 0))) div (cast(l AS decimal(19, 0)) * cast(r AS decimal(19, 0)))")
    best = F.min(F.struct(exact.alias("score"), "cut", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "k", "a").agg(best).select("lang", "phrase", "k", "a", "best.l", "best.r", "best.score")


def outermost(found: DataFrame, rows: DataFrame, percent: int = INSIDE_PERCENT) -> DataFrame:
    """Without phrases that lie in a longer one which has ``percent`` of their occurrences or more."""
    inner = found.where("k > 2").select("lang", "k", "f", F.split("phrase", " ").alias("w"))
    inner = inner.select("lang", "f", "w", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
    inner = inner.select("lang", "f", "w", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("from"))
    inner = inner.select("lang", "f", F.array_join(F.slice("w", F.col("from"), F.col("size")), " ").alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = rows.join(most, ["lang", "phrase"], "left").where(F.coalesce(F.lit(100) * F.col("longer") < F.lit(percent) * F.col("a"), F.lit(True)))
    return kept.drop("longer")


def ranked(rows: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language by score and frequency, both descending, then phrase. While a language has
    more than ``LANE`` rows its lanes are ranked first, so no task sorts all phrases of a language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = settle(rows, "collocation-scores")
    while (most := rows.groupBy("lang").count().agg(F.max("count")).first()[0] or 0) > max(LANE, 2 * top):
        lane = F.pmod(F.xxhash64("phrase"), F.lit(B.counts(most, max(LANE, 2 * top))))
        first = F.row_number().over(Window.partitionBy("lang", "lane").orderBy(*order))
        rows = settle(rows.withColumn("lane", lane).withColumn("nr", first).where(F.col("nr") <= top).drop("lane", "nr"), "collocation-lanes")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def mine(docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = LONGEST, least: int = LEAST,
         percent: int = INSIDE_PERCENT, top: int = TOP, cycle: int = SHARDS, bits: int | None = None) -> DataFrame:
    """The best collocations of each language: lang, rank, phrase, a, l, r, n, score."""
    found, n = count(docs, lang, text, longest, least, cycle, bits)
    best = ranked(outermost(found, scored(found), percent), top)
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
