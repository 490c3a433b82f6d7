"""Main text of web pages: a suffix array of each host's page streams, checked against the regions that the markup names.

1. Pages become blocks (``html_blocks``).  The markup proposes a main region: what
   stands in the elements that it names most strongly as the article, unless they
   hold less than ``REGION_SHARE`` of the text of more weakly named ones (a teaser
   card beside or inside the body); the other blocks are its surroundings.
2. Main regions and surroundings of all pages of a host are two collections of token
   streams, and every page is in them, whatever its markup names.  The suffix array
   is needed only as deep as ``MIN_WORDS`` words: neighbours that share as many words
   are exactly the suffixes with the same first ``MIN_WORDS`` words.  So the array is
   built by a 64-bit key of host, collection and those words.  A task sorts the keys
   of its pages and cuts them into ``RANGES`` ranges of keys; a range is merged in a
   group of its own, so a host with a third of all pages is no hot task.  Equal
   neighbours are a repeated substring, and their number is the number of pages that
   have it.  Lists travel as differences, their high bytes compressed.  A block
   shorter than ``MIN_WORDS`` is one suffix, closed by a sentinel.
3. Repeated substrings go back to the pages that they can decide.  A page whose markup
   names no region keeps the unique runs outside menus, headers, footers, sidebars,
   notices, adverts, forms and reader comments; what repeats is boilerplate.  Where a
   larger region stands against a more strongly named one, only its unique text
   counts against that one: boilerplate is no body.
4. In named regions, the array decides which blocks are the host's boilerplate
   (``boilerplate``), and these are taken out: every run of the block also stands on
   several pages in what the markup names as menu, footer, notice, advert and so on,
   and the block is in at least half of the host's different main regions.  These
   blocks return to all pages of their host.  What articles repeat of one another
   alone is quotation or copy, and taking it out loses text (224 of 2,500 pages of
   sf0.1); a headline that stands in menus is in one region only.  The markup is the
   exact check that follows: it says what a region is, and no region loses all of it.

Pages with equal blocks count as one page: a substring repeats where more pages have
it than there are pages with the same blocks, so mirrors do not erase each other.

Edge cases: NULL and empty html give the empty text; a page without a block
likewise; a NULL or unreadable url is host ''; repeated rows give equal results;
cut-off markup is read as far as it goes; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm import _tokens as T
from inkwell.llm._scratch import materialize, ship
from inkwell.llm.html_blocks import placed_blocks

MIN_WORDS = 8
REGION_SHARE = 1 / 3
# Different main regions of a host that hold a block of its boilerplate, at least.
MIN_REGIONS = 3
# Kinds of lists: what stands outside main regions, there in blocks that the markup names as side, and in main regions.
AROUND, SIDE, MAIN = 0, 1, 2
# Tells the keys of main regions from those of their surroundings.
MAIN_KEY = np.uint64(0x5851F42D4C957F2D)
# Ranges of keys; one is merged at a time.
RANGES = 1024
# Keys that a task sorts in one go.
CHUNK_KEYS = 2_000_000
# Low bytes of a difference, which are as good as random and travel as they are.
LOW = 5

_LISTS = "range int, kind int, size int, low binary, high binary"
_REPEATED = "key long, pages long, boiler boolean"
_RUNS = "host string, part long, key long"
_SUFFIXES = "row binary, host string, page long, key long, block int, start int"
_DIGESTS = ("page_id long, url string, host string, row binary, page long, open boolean, main array<boolean>, "
            "side array<boolean>, levels array<int>, blocks array<string>, region long, leads array<long>, parts array<long>")
_TEXTS = "page_id long, url string, text string, n_chars long"

Block = tuple[int, bool, frozenset[int], str]


def _inside(best: int, side: bool, levels: frozenset[int]) -> bool:
    return best > 0 and best in levels and not side


def _best(found: list[Block], sizes: list[int]) -> int:
    """The level of the main region, 0 for none; ``sizes``: what each block counts against more strongly named ones."""
    whole = {n: sum(len(t) for _, side, levels, t in found if n in levels and not side) for n in (3, 2, 1)}
    held = {n: sum(x for (_, side, levels, _), x in zip(found, sizes, strict=True) if n in levels and not side) for n in (3, 2, 1)}
    return next((n for n in (3, 2, 1) if whole[n] and whole[n] >= REGION_SHARE * max(whole[n], *(held[m] for m in (3, 2, 1) if m != n))), 0)


def _split(html: str | None) -> tuple[list[Block], list[bool], bool]:
    """(blocks, whether each is in the main region, whether repeated substrings can decide the page)."""
    found = placed_blocks(html or "")
    best = _best(found, [len(t) for *_, t in found])
    strongest = max((n for _, side, levels, _ in found if not side for n in levels), default=0)
    return found, [_inside(best, side, levels) for _, side, levels, _ in found], best == 0 or best < strongest


def regions(html: str | None) -> tuple[list[str], list[tuple[bool, str]]]:
    """(blocks of the main region, (side, block) of the surroundings), as the markup proposes them."""
    found, inside, _ = _split(html)
    return ([t for (_, _, _, t), x in zip(found, inside, strict=True) if x],
            [(side, t) for (_, side, _, t), x in zip(found, inside, strict=True) if not x])


def _page(found: list[Block], inside: list[bool]) -> int:
    main = [t for (*_, t), x in zip(found, inside, strict=True) if x]
    around = [t for (*_, t), x in zip(found, inside, strict=True) if not x]
    return xxhash.xxh3_64_intdigest("\n".join([*main, "", *around]))


def _part(host: str, text: str) -> int:
    """A block of a host, as a number."""
    n = xxhash.xxh3_64_intdigest(f"{host} {text}")
    return n - (1 << 64) if n >> 63 else n


def _own(host: str, texts: list[str], gone: list[int] | None) -> str:
    """The text of a main region without its host's boilerplate."""
    own = [t for t in texts if _part(host, t) not in gone] if gone else texts
    return " ".join(own or texts)


def _digest(min_words: int):
    """Every page with its main region's blocks as numbers and the keys of their first suffixes; blocks themselves only
    where repeated substrings can decide what the main region is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = T.WordHashes()
        for batch in batches:
            split = [_split(html) for html in batch.column("html").to_pylist()]
            pages = [_page(found, inside) for found, inside, _ in split]
            mains = [[b[3] for b, x in zip(found, inside, strict=True) if x] for found, inside, _ in split]
            hosts = batch.column("host").to_pylist()
            leads = [page_suffixes(cache, host, [" ".join(t.split(" ", min_words)[:min_words]) for t in texts], min_words)[0].view(np.int64)
                     for host, texts in zip(hosts, mains, strict=True)]
            regions_ = [_part("", "\n".join(texts)) if texts else None for texts in mains]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("page_id", "url", "host", "row")), pa.array(np.array(pages, np.uint64).view(np.int64)),
                 pa.array([o for *_, o in split], pa.bool_()),
                 pa.array([inside if o else None for _, inside, o in split], pa.list_(pa.bool_())),
                 pa.array([[b[1] for b in found] if o else None for found, _, o in split], pa.list_(pa.bool_())),
                 pa.array([[sum(1 << n for n in b[2]) for b in found] if o else None for found, _, o in split], pa.list_(pa.int32())),
                 pa.array([[b[3] for b in found] if o else None for found, _, o in split], pa.list_(pa.string())),
                 pa.array(regions_, pa.int64()), pa.array(leads, pa.list_(pa.int64())),
                 pa.array([[_part(host, t) for t in texts] for host, texts in zip(hosts, mains, strict=True)], pa.list_(pa.int64()))],
                names=["page_id", "url", "host", "row", "page", "open", "main", "side", "levels", "blocks", "region", "leads", "parts"])
    return run


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The main region, without its host's boilerplate, of the pages whose region the markup settles."""
    for batch in batches:
        split = [_split(html) for html in batch.column("html").to_pylist()]
        kept = pa.array([i for i, (*_, o) in enumerate(split) if not o], pa.int64())
        texts = [_own(host, [b[3] for b, x in zip(found, inside, strict=True) if x], gone)
                 for (found, inside, o), host, gone in zip(split, batch.column("host").to_pylist(), batch.column("gone").to_pylist(), strict=True)
                 if not o]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id").take(kept), batch.column("url").take(kept), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def page_suffixes(cache: T.WordHashes, host: str, blocks: list[str], min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, block numbers, starts) of a page's suffixes: all words are hashed in one go."""
    words = [T.split_words(t) for t in blocks]
    sizes = np.array([len(w) for w in words], np.int64)
    hashes = cache.of([x for w in words for x in w])
    block = np.repeat(np.arange(len(words)), sizes)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.arange(len(hashes))
    left = first + sizes[block] - at if len(hashes) else at        # words of the block from here on
    short = sizes[block] < min_words
    whole = (at == first) & short
    chosen = np.nonzero(whole | (left >= min_words))[0]
    length = np.where(short, left, min_words)[chosen]
    keys = T.Rolling(hashes).ranges(chosen, chosen + length)
    # a short block is closed by a sentinel, so it is no prefix of a longer one
    keys = np.where(short[chosen], T.mix(keys + T.U64(T.M2) * length.astype(np.uint64)), keys)
    keys = T.mix(keys ^ np.uint64(xxhash.xxh3_64_intdigest(host)))
    return keys, block[chosen].astype(np.int32), (chosen - first[chosen]).astype(np.int32)


def pack(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending keys and their counts as (low bytes, compressed high bytes) of the differences."""
    steps = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    high = steps[LOW:].tobytes() + counts.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
    return steps[:LOW].tobytes(), pa.compress(high, codec="zstd", asbytes=True)


def unpack(size: int, low: bytes, high: bytes) -> tuple[np.ndarray, np.ndarray]:
    high = pa.decompress(high, decompressed_size=size * (12 - LOW), codec="zstd", asbytes=True)
    planes = np.frombuffer(low + high, np.uint8).reshape(12, size)
    steps, counts = np.ascontiguousarray(planes[:8].T).view(np.uint64)[:, 0], np.ascontiguousarray(planes[8:].T).view(np.uint32)[:, 0]
    return np.cumsum(steps, dtype=np.uint64), counts


def merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0] if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order].astype(np.int64), first) if len(keys) else np.zeros(0, np.int64)


def _sorted_lists(min_words: int):
    def lists(kind: int, found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys = np.concatenate(found)
        keys, counts = merge(keys, np.ones(len(keys), np.int64))
        ranges = (keys >> np.uint64(64 - (RANGES - 1).bit_length())).astype(np.int64)
        cuts = np.searchsorted(ranges, np.arange(RANGES + 1))
        rows = [(r, kind, b - a, *pack(keys[a:b], counts[a:b])) for r, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
        for at in range(0, len(rows), 256):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows[at:at + 256], strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
                names=["range", "kind", "size", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, found, size = T.WordHashes(), ([], [], []), 0
        for batch in batches:
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                blocks, main, _ = _split(html)
                keys, block, _ = page_suffixes(cache, host, [b[3] for b in blocks], min_words)
                kind = np.array([MAIN if x else SIDE if b[1] else AROUND for b, x in zip(blocks, main, strict=True)], np.int64)[block]
                # a page counts once for each of its keys in its main region, and once around it
                for k in (MAIN, SIDE, AROUND):
                    found[k].append(np.unique(keys[kind == k]))
                if len(found[SIDE][-1]) and len(found[AROUND][-1]):
                    found[AROUND][-1] = np.setdiff1d(found[AROUND][-1], found[SIDE][-1], assume_unique=True)
                size += sum(len(f[-1]) for f in found)
                if size >= CHUNK_KEYS:
                    for k in (AROUND, SIDE, MAIN):
                        yield from lists(k, found[k])
                    found, size = ([], [], []), 0
        if size:
            for k in (AROUND, SIDE, MAIN):
                yield from lists(k, found[k])
    return run


def _neighbours(table: pa.Table) -> pa.Table:
    lists = {k: [(np.zeros(0, np.uint64), np.zeros(0, np.uint32))] for k in (AROUND, SIDE, MAIN)}
    for kind, *packed in zip(*(table.column(c).to_pylist() for c in ("kind", "size", "low", "high")), strict=True):
        lists[kind].append(unpack(*packed))
    side = merge(*(np.concatenate(c) for c in zip(*lists[SIDE], strict=True)))[0]
    around, pages = merge(*(np.concatenate(c) for c in zip(*lists[AROUND], *lists[SIDE], strict=True)))
    main, regions_ = merge(*(np.concatenate(c) for c in zip(*lists[MAIN], strict=True)))
    around, pages = around[pages > 1], pages[pages > 1]
    boiler = np.isin(around, side, assume_unique=True) & np.isin(around, main[regions_ >= MIN_REGIONS], assume_unique=True)
    main, regions_ = main[regions_ > 1], regions_[regions_ > 1]
    return pa.table({"key": np.concatenate([around, main ^ MAIN_KEY]).view(np.int64), "pages": np.concatenate([pages, regions_]),
                     "boiler": np.concatenate([boiler, np.zeros(len(main), bool)])})


def repeated(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``key, pages, boiler``: suffix keys that several rows have, with their number.  ``rows``: host, html of every page.

    ``boiler``: it stands around main regions, in blocks that the markup names as side among others, and in
    ``MIN_REGIONS`` main regions, too.
    """
    lists = rows.select("host", "html").mapInArrow(_sorted_lists(min_words), _LISTS)
    return lists.groupBy("range").applyInArrow(_neighbours, _REPEATED)


def _runs(min_words: int):
    """The keys of all suffixes of the main regions' blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = T.WordHashes()
        for batch in batches:
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                found, inside, _ = _split(html)
                texts = [b[3] for b, x in zip(found, inside, strict=True) if x]
                keys, block, _ = page_suffixes(cache, host, texts, min_words)
                parts = np.array([_part(host, t) for t in texts], np.int64)[block]
                yield pa.RecordBatch.from_arrays([pa.array([host] * len(keys), pa.string()), pa.array(parts), pa.array(keys.view(np.int64))],
                                                 names=["host", "part", "key"])
    return run


def boilerplate(rows: DataFrame, digests: DataFrame, common: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``host, gone array<long>``: the blocks that are boilerplate of their host inside main regions.

    Every run of such a block stands in named surroundings as well (``boiler`` of ``repeated``), and at least
    ``MIN_REGIONS`` and half of the different main regions of the host have the block.  The first suffixes
    propose blocks; all suffixes of a proposed one are asked on one page that has it.
    """
    keys = materialize(common.filter("boiler").select("key", F.lit(True).alias("named")), "boiler-suffixes")
    # mirrors are one region
    met = (digests.select("host", "row", "region", F.explode(F.arrays_zip("leads", "parts")).alias("b"))
           .select("host", "row", "region", F.col("b.leads").alias("key"), F.col("b.parts").alias("part")).join(keys, "key"))
    several = materialize(met.groupBy("host", "part").agg(F.count_distinct("region").alias("n"), F.min("row").alias("row"))
                          .filter(F.col("n") >= MIN_REGIONS), "boiler-blocks")
    of = (digests.join(several.select("host").distinct(), "host", "left_semi").filter("region is not null")
          .groupBy("host").agg(F.count_distinct("region").alias("of")))
    half = materialize(several.join(of, "host").filter("2 * n >= of").select("host", "part", "row"), "boiler-half")
    runs = rows.join(half.select("row").distinct(), "row", "left_semi").select("host", "html").mapInArrow(_runs(min_words), _RUNS)
    whole = (runs.join(half.select("host", "part").distinct(), ["host", "part"], "left_semi").join(keys, "key", "left")
             .groupBy("host", "part").agg(F.bool_and(F.coalesce("named", F.lit(False))).alias("whole")).filter("whole"))
    return whole.groupBy("host").agg(F.collect_set("part").alias("gone"))


def _suffixes(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = T.WordHashes()
        for batch in batches:
            found = []
            for host, blocks, main in zip(*(batch.column(c).to_pylist() for c in ("host", "blocks", "main")), strict=True):
                keys, block, start = page_suffixes(cache, host, blocks, min_words)
                found.append((np.where(np.array(main, bool)[block], keys ^ MAIN_KEY, keys), block, start))
            rows = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
            if len(rows):
                keys, blocks, starts = (np.concatenate(c) for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(rows) for c in ("row", "host", "page")), pa.array(keys.view(np.int64)), pa.array(blocks), pa.array(starts)],
                    names=["row", "host", "page", "key", "block", "start"])
    return run


def repeated_spans(digests: DataFrame, common: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``row, spans array<struct<block, start>>`` of the open pages: suffix starts that stand on another page of the
    host, too.

    ``digests``: as of ``_DIGESTS``; ``common``: as of ``repeated``.
    """
    mirrors = digests.groupBy("host", "page").agg(F.count("*").alias("alike"))
    suffixes = digests.filter("open").select("row", "host", "page", "blocks", "main").mapInArrow(_suffixes(min_words), _SUFFIXES)
    return (suffixes.join(common.select("key", "pages").hint("merge"), "key").join(mirrors.hint("merge"), ["host", "page"]).filter("pages > alike")
            .groupBy("row").agg(F.collect_set(F.struct("block", "start")).alias("spans")))


def decided(found: list[Block], spans: list[dict] | None, min_words: int, host: str = "", boiler: list[int] | None = None) -> str:
    """The text of an open page: its main region, judged by unique text and without the host's boilerplate, or else its
    unique runs."""
    covered: dict[int, list[int]] = {}
    for s in spans or ():
        covered.setdefault(s["block"], []).append(s["start"])
    unique = []
    for b, (*_, text) in enumerate(found):
        words = text.split()
        gone = np.zeros(len(words), bool)
        for s in covered.get(b, ()):
            gone[s:s + min_words] = True
        unique.append(" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g))
    best = _best(found, [len(t) for t in unique])
    if best:
        return _own(host, [t for _, side, levels, t in found if _inside(best, side, levels)], boiler)
    return " ".join(t for t, (_, side, *_) in zip(unique, found, strict=True) if t and not side)


def _decided(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decided([(0, s, frozenset(n for n in range(4) if m >> n & 1), t) for s, m, t in zip(side, levels, blocks, strict=True)],
                             spans, min_words, host, gone)
                     for side, levels, blocks, spans, host, gone
                     in zip(*(batch.column(c).to_pylist() for c in ("side", "levels", "blocks", "spans", "host", "gone")), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return run


def extract_text(pages: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row."""
    ship(pages.sparkSession)
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url",
        F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)", 1)).alias("host"),
        F.unhex(F.md5(F.concat_ws("\u0000", F.col("page_id").cast("string"), "url", html))).alias("row"), html.alias("html"))
    common = materialize(repeated(rows, min_words), "repeated-suffixes")
    digests = materialize(rows.mapInArrow(_digest(min_words), _DIGESTS), "page-digests")
    gone = materialize(boilerplate(rows, digests, common, min_words), "boilerplate")
    settled = rows.select("page_id", "url", "host", "html").join(gone, "host", "left").mapInArrow(_settled, _TEXTS)
    undecided = digests.filter("open").select("page_id", "url", "host", "row", "side", "levels", "blocks").join(gone, "host", "left")
    joined = undecided.join(repeated_spans(digests, common, min_words), "row", "left")
    return settled.unionByName(joined.select("page_id", "url", "host", "side", "levels", "blocks", "spans", "gone").mapInArrow(_decided(min_words), _TEXTS))
