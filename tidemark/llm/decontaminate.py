"""Benchmark decontamination with a broadcast hash set of test n-grams.

DataFrame functions only. Test items become windows of 13 consecutive words
(an item of fewer words is one window of its own length). Every window of
every document is hashed, looked up in the broadcast set of test windows, and
a hit is verified word by word before it counts.

Documents are cut into chunks of words first, so the cost of a window does not grow
with its text. Windows that stand in the same items share one name for that set of items,
which is resolved to ids once for each combination that documents have.

The test windows are counted and their bytes summed before they are broadcast; a benchmark of
more than ``BROADCAST_ROWS`` windows or ``BROADCAST_BYTES`` is joined by shuffle with the same result: only
places and hashes travel, then the words of the places found.

Defined results: null or empty texts have no words and are never
contaminated; null or empty items have no window; items with the same id are
one item; repeated documents get equal results, one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_ROWS, by_keys, cut, text_key, unused

WINDOW = 13
SHARE = 20  # contaminated from one word in so many
CHUNK = 64  # words of a document that travel with its windows, and 12 more
BROADCAST_BYTES = 64 << 20  # of test windows' words
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised_words(text: str) -> Column:
    """Words of the text with A-Z (and only A-Z) lower-cased."""
    t = F.coalesce(F.col(text), F.lit(""))
    ascii_only = F.octet_length(t) == F.length(t)
    lowered = F.when(ascii_only, F.lower(t)).otherwise(F.translate(t, _UPPER, _UPPER.lower()))
    return F.array_remove(F.split(lowered, GAP), "")


def _window_hash(words: str, at: str, size: int) -> str:
    """Hash of the window of ``size`` words that begins at index ``at`` (from 0): of its length and all its words."""
    return f"xxhash64({size}, slice({words}, {at} + 1, {size}))"


def test_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Rows (len, hash, words, item_id): the windows of every test item."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item_id"), normalised_words(text).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(WINDOW)))
    at = F.explode(F.expr("transform(sequence(0, size(w) - len), i -> slice(w, i + 1, len))")).alias("words")
    each = " ".join(f"WHEN {m} THEN {_window_hash('words', '0', m)}" for m in range(1, WINDOW + 1))
    return items.select("item_id", "len", at).select(
        "len", F.expr(f"CASE len {each} END").alias("hash"), "words", "item_id").distinct()


def _item_sets(tests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (t_len, t_hash, t_words, items) and members (items, item_id).

    Windows that stand in the same items share a set of items, named by its size and two sums (xor) of
    hashes of its ids; so a window joins once, however many items hold it, and no list of items is gathered.
    """
    name = F.concat_ws(":", F.count("*"), F.bit_xor(F.xxhash64("item_id")), F.bit_xor(F.xxhash64("item_id", F.lit(1))))
    windows = cut(tests.groupBy("len", "hash", "words").agg(name.alias("items")))
    first = windows.groupBy("items").agg(F.min(F.struct("len", "hash", "words")).alias("one")).select("items", "one.*")
    members = tests.join(first, ["len", "hash", "words"]).select("items", "item_id")
    side = windows.select(F.col("len").alias("t_len"), F.col("hash").alias("t_hash"), F.col("words").alias("t_words"),
                          "items")
    return side, cut(members)


def _chunks(src: DataFrame) -> DataFrame:
    """Each document as rows of ``CHUNK`` words and the 12 that follow them (one row for a text without words), so
    that a window's row carries a few words, whatever the length of its text."""
    each = (f"transform(sequence(0, greatest(n - 1, 0), {CHUNK}), "
            f"b -> named_struct('base', b, 'c', slice(w, b + 1, {CHUNK + WINDOW - 1})))")
    return src.select("doc_id", "key", "n", F.expr(f"inline({each})"))


def _windows_of(size: int) -> str:
    """How many windows of ``size`` words begin in the chunk's own words."""
    return f"greatest(0, least({CHUNK}, size(c) - {size} + 1))"


def _scanned(chunks: DataFrame, lengths: list[int]) -> DataFrame:
    """One row per document (pos = 0 of its first chunk, no hash), then one
    per window of each length in turn."""
    hashes = [f"transform(if({_windows_of(m)} > 0, sequence(0, {_windows_of(m)} - 1), array()), "
              f"i -> {_window_hash('c', 'i', m)})" for m in lengths]
    found = f"concat({', '.join(['array(cast(null as bigint))', *hashes])})"
    rows = chunks.select("doc_id", "key", "n", "base", "c", F.posexplode(F.expr(found)).alias("pos", "hash"))
    return rows.where("pos > 0 or base = 0")


def _start(lengths: list[int]) -> str:
    """First word (from 0, in the chunk) of the window at ``pos`` of length ``t_len``."""
    before, cases = ["1"], []
    for m in lengths:
        cases.append(f"WHEN {m} THEN pos - ({' + '.join(before)})")
        before.append(_windows_of(m))
    return f"CASE t_len {' '.join(cases)} END" if cases else "cast(null as int)"


def _span(at: Column, length: str) -> Column:
    return F.struct(at.alias("start"), (at + F.col(length)).alias("end"))


def _by_broadcast(src: DataFrame, side: DataFrame, lengths: list[int]) -> DataFrame:
    """A row per document (is_doc) and one per verified hit (span, items)."""
    hits = _scanned(_chunks(src), lengths).join(F.broadcast(side), F.col("hash") == F.col("t_hash"), "left")
    # the row of the document itself stays; a hit must equal its window
    is_doc = F.col("pos") == 0
    at = F.expr(_start(lengths))
    same = F.slice("c", F.greatest(at, F.lit(0)) + 1, F.col("t_len")) == F.col("t_words")
    return hits.where(is_doc | ((at >= 0) & same)).select(
        "doc_id", "key", F.col("n").cast("long").alias("n_words"), F.when(is_doc, F.lit(1)).alias("is_doc"),
        F.when(~is_doc, _span(F.col("base") + at, "t_len")).alias("span"), F.when(~is_doc, F.col("items")).alias("items"))


def _by_shuffle(src: DataFrame, side: DataFrame, lengths: list[int]) -> DataFrame:
    """The rows of ``_by_broadcast`` for test windows of any number.

    Windows travel as places and hashes, never with their document's words;
    the words of a place are cut out of its chunk only where its hash is a test window's.
    """
    chunks = _chunks(src)
    known = side.select("t_len", "t_hash").distinct()
    slim = _scanned(chunks, lengths).where(F.col("hash").isNotNull())
    slim = slim.select("doc_id", "key", "base", "pos", "hash", F.size("c").alias("size_c"))
    places = (slim.join(known, F.col("hash") == F.col("t_hash"))
              .select(F.col("doc_id").alias("p_id"), F.col("key").alias("p_key"), F.col("base").alias("p_base"),
                      F.expr(_start(lengths).replace("size(c)", "size_c")).alias("at"),
                      F.col("t_len").alias("p_len"), F.col("t_hash").alias("p_hash")).where("at >= 0").distinct())
    words = (chunks.join(places, F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("key") == F.col("p_key"))
                         & (F.col("base") == F.col("p_base")))
             .select("doc_id", "key", "base", "at", "p_len", "p_hash", F.expr("slice(c, at + 1, p_len)").alias("p_words")))
    hits = words.join(side, (F.col("p_hash") == F.col("t_hash")) & (F.col("p_len") == F.col("t_len"))
                      & (F.col("p_words") == F.col("t_words")))
    return src.select("doc_id", "key", F.col("n").cast("long").alias("n_words"), F.lit(1).alias("is_doc")).unionByName(
        hits.select("doc_id", "key", _span(F.col("base") + F.col("at"), "t_len").alias("span"), "items"),
        allowMissingColumns=True)


def _fits(side: DataFrame) -> bool:
    """Whether the test windows may be broadcast: by their number and by their bytes."""
    n, size = side.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.concat_ws(" ", "t_words"))), F.lit(0))).first()
    return n <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: doc_id, key (its text's hash), n_words, n_hit,
    items (sorted ids), spans (ranges of hit words, end exclusive, sorted)."""
    tests = cut(test_windows(benchmark, item_id, item_text))
    lengths = sorted(r[0] for r in tests.select("len").distinct().collect())  # at most 13 rows
    side, members = _item_sets(tests)
    src = docs.select(F.col(id_col).alias("doc_id"), text_key(text).alias("key"), normalised_words(text).alias("w"))
    src = src.select("doc_id", "key", "w", F.size("w").alias("n"))
    found = _by_broadcast if _fits(side) else _by_shuffle
    covered = """aggregate(spans, named_struct('total', 0L, 'end', 0), (a, x) -> named_struct(
        'total', a.total + greatest(0, x.end - greatest(x.start, a.end)), 'end', greatest(a.end, x.end)),
        a -> a.total)"""
    rows = found(src, side, lengths).groupBy("doc_id", "key").agg(
        F.max("n_words").alias("n_words"), F.sum("is_doc").alias("copies"),
        F.array_sort(F.collect_set("span")).alias("spans"), F.array_sort(F.collect_set("items")).alias("sets"))
    rows = cut(rows.withColumn("n_hit", F.expr(covered)))
    # the ids of each distinct combination of sets are gathered once, however many documents have it
    own = rows.where(F.size("sets") > 0).select("sets").distinct()
    named = own.withColumn("items", F.explode("sets")).join(members, "items").groupBy("sets").agg(
        F.array_sort(F.collect_set("item_id")).alias("ids")).withColumnRenamed("sets", "own_sets")
    columns = ["doc_id", "key", "n_words", "n_hit", "items", "spans", "copies"]
    hit = rows.join(named, F.col("sets") == F.col("own_sets")).withColumn("items", F.col("ids")).select(columns)
    # documents without a hit, most of them, need no join
    clean = rows.where(F.size("sets") == 0).withColumn("items", F.col("sets")).select(columns)
    rows = hit.unionByName(clean)
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copy", "copies")


def is_contaminated() -> Column:
    return (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), is_contaminated().alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                      item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Documents that are not contaminated, with their own columns."""
    h = unused(docs, "text_hash")
    bad = contamination(docs, benchmark, id_col, text, item_id, item_text).where(is_contaminated())
    keyed = docs.withColumn(h, text_key(text))
    bad = bad.select(F.col("doc_id").alias(id_col), F.col("key").alias(h))
    return by_keys(keyed, bad, [id_col, h], "left_anti").select(docs.columns)


def cut_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
              item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Documents with the hit words (and the text between them) removed; the
    other texts stay as they are. Only texts with hits are shuffled."""
    h, spans = unused(docs, "text_hash"), unused(docs, "hit_spans")
    hit = (contamination(docs, benchmark, id_col, text, item_id, item_text).where("n_hit > 0")
           .select(F.col("doc_id").alias(id_col), F.col("key").alias(h), F.col("spans").alias(spans))
           .dropDuplicates([id_col, h]))
    hit = cut(hit)
    keyed = docs.withColumn(h, text_key(text))
    clean = by_keys(keyed, hit, [id_col, h], "left_anti").select(docs.columns)
    found = by_keys(keyed, hit, [id_col, h], "left_semi")
    raw, gaps, own_id, own_key = (unused(found, n) for n in ("raw_", "gaps_", "hit_id_", "hit_key_"))
    side = hit.select(F.col(id_col).alias(own_id), F.col(h).alias(own_key), spans)
    found = found.join(side, F.col(id_col).eqNullSafe(F.col(own_id)) & (F.col(h) == F.col(own_key)))
    # gaps[i] stands before word i; the text is gaps[0] words[0] gaps[1] ... gaps[n]
    word = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
    found = (found.withColumn(raw, F.regexp_extract_all(F.col(text), F.lit(word), F.lit(0)))
             .withColumn(gaps, F.split(F.col(text), word, -1)))
    inside = f"exists(`{spans}`, x -> i - {{0}} >= x.start and i - {{0}} < x.end)"
    parts = (f"transform(sequence(1, size(`{raw}`)), i -> if({inside.format(1)}, '', concat("
             f"if(i > 1 and {inside.format(2)}, ' ', `{gaps}`[i - 1]), `{raw}`[i - 1])))")
    found = found.withColumn(text, F.expr(f"concat(array_join({parts}, ''), `{gaps}`[size(`{raw}`)])"))
    return clean.unionByName(found.select(docs.columns))
