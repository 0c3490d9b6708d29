"""Pages of the examples, overlapping chunks, first-occurrence dedup, ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import settings
from ..functions import text as tx
from ..functions.binding import sequence_key, split_key
from .numbering import assign_positions

_CHUNKS_PER_PAGE = 10**9
# Sorts behind all corpus orders.
_LAST = "9" * 38
# What tells a page from all others but its copies, and a chunk of it.
_PAGE = ("example_ord", "page_pos", "_page")
_PLACE = (*_PAGE, "chunk_pos")
# Bits that tell pages with a first passage, at every size: 16 MB, 64 a row.
_SLOTS = 2**27


def unnest_pages(examples: DataFrame) -> DataFrame:
    """One row per page: titles and contexts paired up to the shorter list."""
    titles, contexts = F.col("entity_pages.title"), F.col("entity_pages.wiki_context")
    both = F.least(F.size(titles), F.size(contexts))
    pairs = F.when(
        both > 0,
        F.arrays_zip(
            F.slice(titles, 1, both).alias("title"), F.slice(contexts, 1, both).alias("text")
        ),
    )
    return examples.select(
        F.col("ord").alias("example_ord"), F.posexplode(pairs).alias("page_pos", "page")
    ).select(
        "example_ord",
        "page_pos",
        tx.title_or_default(F.col("page.title")).alias("title"),
        F.col("page.text").alias("text"),
    )


def chunk_pages(
    pages: DataFrame,
    chunking: settings.Chunking = settings.Chunking(),
    tokenizer: tx.Tokenizer = tx.BLANK_TOKENIZER,
) -> DataFrame:
    """Overlapping token windows, each prefixed with its page title.

    The default tokenizer cuts a text by its bytes; `model_tokenizer` wraps others.
    """
    return _cut(pages, [chunking], tokenizer).drop("_at")


def chunk_sweep(
    pages: DataFrame,
    sweep: Sequence[settings.Chunking],
    tokenizer: tx.Tokenizer = tx.BLANK_TOKENIZER,
    numbers: Sequence[int] | None = None,
) -> DataFrame:
    """Chunks for several settings at once; `run` numbers them from 1, or as `numbers` says.

    A page is read and tokenised once and then cut per setting.
    """
    def of_run(values) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("_at"))

    cut = _cut(pages, sweep, tokenizer)
    return cut.select(
        *[c for c in cut.columns if c not in ("_at", "chunk_pos", "passage")],
        of_run(numbers or range(1, len(sweep) + 1)).alias("run"),
        of_run([c.tokens for c in sweep]).alias("chunk_tokens"),
        of_run([c.overlap for c in sweep]).alias("chunk_overlap"),
        "chunk_pos",
        "passage",
    )


def _cut(pages: DataFrame, sweep: Sequence[settings.Chunking], tokenizer: tx.Tokenizer) -> DataFrame:
    """The chunks of each setting, whose place in `sweep` is `_at`."""
    cuts = [(c.tokens, c.step) for c in sweep]
    whole = _tokenised(pages, cuts, tokenizer)
    if tokenizer.cut:
        # There is an entry for every setting. Without "outer" a filter on their number would be inferred and cut all texts once more.
        per_run, decode = whole.select("*", F.posexplode_outer("_cut").alias("_at", "_windows")), lambda chunk: chunk
    else:
        steps = F.array(*[F.struct(F.lit(i).alias("_at"), F.lit(a).alias("_size"), F.lit(b).alias("_step")) for i, (a, b) in enumerate(cuts)])
        inlined = whole.select("*", F.inline(steps))
        per_run, decode = inlined.withColumn("_windows", tx.windows(F.col("_cut"), F.col("_size"), F.col("_step"))), tokenizer.decode
    chunks = per_run.drop("_cut", "_size", "_step").select("*", F.posexplode("_windows").alias("chunk_pos", "_chunk"))
    return chunks.select(
        "*", F.concat("title", F.lit(": "), decode(F.col("_chunk"))).alias("passage")
    ).drop("_windows", "_chunk")


def _tokenised(pages: DataFrame, cuts: Sequence[tuple[int, int]], tokenizer: tx.Tokenizer) -> DataFrame:
    """Pages with `_cut` in place of the text: the windows of each (size, step), or the tokens."""
    return pages.select(
        *[c for c in pages.columns if c not in ("text", "title")],
        tx.title_or_default(F.col("title")).alias("title"),
        (tokenizer.cut(F.col("text"), cuts) if tokenizer.cut else tokenizer.encode(F.col("text"))).alias("_cut"),
    )


def corpus_order() -> Column:
    """Example, page and chunk position as one sortable number."""
    within = F.col("page_pos").cast("bigint") * _CHUNKS_PER_PAGE + F.col("chunk_pos")
    return sequence_key(F.col("example_ord"), within)


def unpack_order(order: Column) -> Column:
    """The example, page and chunk position inside a corpus-order number."""
    example, within = split_key(order)
    chunk = within % _CHUNKS_PER_PAGE
    return F.struct(
        example.alias("example_ord"),
        ((within - chunk) / _CHUNKS_PER_PAGE).cast("int").alias("page_pos"),
        chunk.cast("int").alias("chunk_pos"),
    )


def dedup_passages(chunks: DataFrame, *by: str, carried: Sequence[str] = ()) -> DataFrame:
    """Exact dedup that keeps the first occurrence in corpus order.

    Copies collapse inside each task before the shuffle, so a passage that
    fills a third of the corpus is one row per task. `by` adds grouping
    columns, for several corpora in one table; `carried` are numbers of the first occurrence to be kept.
    """
    # A null order is behind all others, as it is for the minimum.
    first = F.coalesce("_order", F.lit(_LAST).cast("decimal(38,0)"))
    return (
        chunks.withColumn("_order", corpus_order())
        .groupBy(*by, "passage")
        .agg(
            F.min("_order").alias("corpus_order"), F.count(F.lit(1)).alias("copies"),
            *[F.min_by(c, first).alias(c) for c in carried],
        )
    )


def first_passages(chunks: DataFrame, *by: str) -> DataFrame:
    """Where each passage occurs first, with dense ids along (by, corpus order), found without moving any text.

    `chunks` are of `marked_pages`. Passages are compared by their 256-bit digests, as streams do.
    Columns: by, example_ord, page_pos, _page, chunk_pos, passage_id.
    """
    digests = chunks.withColumn("passage", F.unhex(F.sha2("passage", 256)))
    kept = dedup_passages(digests, *by, carried=_PLACE).drop("passage", "copies")
    return assign_positions(kept, [*by, "corpus_order"], "passage_id").drop("corpus_order")


def marked_pages(pages: DataFrame) -> DataFrame:
    """Pages with `_page`, which tells those apart that have the same example and position."""
    return pages.select("example_ord", "page_pos", "title", "text", F.xxhash64("title", "text").alias("_page"))


def _with_a_first(pages: DataFrame, firsts: DataFrame) -> DataFrame:
    """`pages` without most of those that have no first passage, found by a set of hashes of bounded size."""
    slot = F.pmod(F.xxhash64(*_PAGE), F.lit(_SLOTS))
    word, bit = F.shiftright(slot, 6).alias("_word"), slot.bitwiseAND(F.lit(63)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("_one")
    known = firsts.select(word, one).groupBy("_word").agg(F.bit_or("_one").alias("_bits"))
    # At most a 64th of the slots in rows: the broadcast side is bounded.
    return pages.join(F.broadcast(known), word == known["_word"]).where(F.getbit("_bits", bit) == 1).drop("_word", "_bits")


def passage_texts(
    pages: DataFrame,
    firsts: DataFrame,
    sweep: Sequence[settings.Chunking],
    tokenizer: tx.Tokenizer = tx.BLANK_TOKENIZER,
) -> DataFrame:
    """The passages at the places that `first_passages` found, in order of their ids: run from 1, passage_id, passage.

    Texts travel once, as pages and not as overlapping chunks: pages meet the list of their first passages in ranges of
    examples, and only these passages are cut out. `firsts` has a column run if there is more than one setting. `pages`,
    as `marked_pages` gives them, are read a second time and must be the same.
    """
    run = F.col("run") if "run" in firsts.columns else F.lit(1)
    at = F.struct(run.alias("run"), "chunk_pos", "passage_id")
    won = firsts.groupBy(*_PAGE).agg(F.array_sort(F.collect_list(at)).alias("_won"))
    kind = won.schema["_won"].dataType
    both = won.select(*_PAGE, F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("text"), "_won").unionByName(
        _with_a_first(pages, firsts).select(*_PAGE, "title", "text", F.lit(None).cast(kind).alias("_won"))
    )
    # The list is right before the first of equal pages, so that a passage comes once.
    before = Window.partitionBy(*_PAGE).orderBy(F.col("_won").isNull())
    found = both.repartitionByRange("example_ord").withColumn("_won", F.lag("_won").over(before)).where(F.col("_won").isNotNull())
    cuts = [(c.tokens, c.step) for c in sweep]
    cut = _tokenised(found, cuts, tokenizer).select("title", "_cut", F.inline("_won"))
    if tokenizer.cut:
        chunk = F.get(F.get("_cut", F.col("run") - 1), F.col("chunk_pos"))
    else:
        size, step = (F.get(F.array(*[F.lit(c[i]) for c in cuts]), F.col("run") - 1) for i in (0, 1))
        chunk = tokenizer.decode(F.slice("_cut", F.col("chunk_pos") * step + 1, size))
    return cut.select("run", "passage_id", F.concat("title", F.lit(": "), chunk).alias("passage"))


def number_passages(passages: DataFrame) -> DataFrame:
    """Dense passage ids along corpus order."""
    return assign_positions(passages, ["corpus_order"], "passage_id").select("passage_id", "passage")
