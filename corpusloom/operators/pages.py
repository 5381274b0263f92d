"""Pages to blocks and chunks; documents to paragraphs and chunks; windows for language models."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html_blocks
from ..functions.batches import slices
from ..functions.chunking import OVERLAP_TOKENS, TARGET_TOKENS, chunk_blocks

_PATH = pa.list_(pa.struct([("level", pa.int16()), ("title", pa.string())]))
_BLOCK = pa.struct(
    [("kind", pa.string()), ("heading_level", pa.int16()), ("text", pa.string()), ("block_index", pa.int64()), ("char_start", pa.int64()), ("char_end", pa.int64()), ("token_estimate", pa.int64()), ("section_path", _PATH)]
)
_CHUNK = pa.struct([("chunk_id", pa.int64()), ("block_index", pa.int64()), ("text", pa.string()), ("token_estimate", pa.int64()), ("char_start", pa.int64()), ("char_end", pa.int64()), ("section_path", _PATH)])
_SQL_PATH = "array<struct<level:smallint,title:string>>"
BLOCKS = f"array<struct<kind:string,heading_level:smallint,text:string,block_index:bigint,char_start:bigint,char_end:bigint,token_estimate:bigint,section_path:{_SQL_PATH}>>"
CHUNKS = f"array<struct<chunk_id:bigint,block_index:bigint,text:string,token_estimate:bigint,char_start:bigint,char_end:bigint,section_path:{_SQL_PATH}>>"


def normalize_pages(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", target: int = TARGET_TOKENS, overlap: int = OVERLAP_TOKENS, max_blocks: int | None = None, strict_boilerplate: bool = False, closed_references: bool = False
) -> DataFrame:
    """(url, body_text, blocks, chunks, checksum, content_length, lossy_decoding, error) of every page.

    checksum is the CRC-32 of the raw bytes, offsets are UTF-8 bytes of body_text. A null or empty page has the error
    'empty body' and no blocks. Rows stay where they are: no shuffle. All blocks of a page count, unless max_blocks asks for the first
    ones. With closed_references only character references that end with a semicolon are decoded; HTML itself decodes some without.
    """
    names = ["body_text", "blocks", "chunks", "checksum", "content_length", "lossy_decoding", "error"]
    kinds = [pa.string(), pa.list_(_BLOCK), pa.list_(_CHUNK), pa.int64(), pa.int64(), pa.bool_(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            rows = [html_blocks.normalize(u, h, target, overlap, max_blocks, strict_boilerplate, closed_references) for u, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True))], ["url", *names])

    picked = pages.select(F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("binary").alias("html"))
    return picked.mapInArrow(run, f"url string, body_text string, blocks {BLOCKS}, chunks {CHUNKS}, checksum bigint, content_length bigint, lossy_decoding boolean, error string")


def page_blocks(normalized: DataFrame) -> DataFrame:
    return normalized.select("url", F.explode("blocks").alias("b")).select("url", "b.*")


def page_chunks(normalized: DataFrame) -> DataFrame:
    return normalized.select("url", F.explode("chunks").alias("c")).select("url", "c.*")


def wiki_blocks(pages: DataFrame, url_col: str = "url", html_col: str = "html", nested: bool = True) -> DataFrame:
    """(url, type, text, section_path, index) of the encyclopedia extractors: document order (nested), or innermost blocks as they close."""
    kernel = html_blocks.wiki_blocks_tree if nested else html_blocks.wiki_blocks_streamed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            rows = [(u, x) for u, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for x in kernel(h or "")]
            if rows:
                fields = [("type", pa.string()), ("text", pa.string()), ("section_path", pa.list_(pa.string())), ("index", pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in rows], pa.string()), *(pa.array([x[n] for _, x in rows], k) for n, k in fields)], ["url", *(n for n, _ in fields)])

    picked = pages.select(F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return picked.mapInArrow(run, "url string, type string, text string, section_path array<string>, index bigint")


def paragraphs(text: str | None) -> list[dict]:
    """Blocks of a plain text: its lines with white space collapsed, blank ones left out."""
    out, at = [], 0
    for line in (text or "").split("\n"):
        words = line.split()
        if words:
            body = " ".join(words)
            size = len(body.encode())
            out.append({"block_index": len(out), "text": body, "char_start": at, "char_end": at + size, "token_estimate": len(words), "section_path": []})
            at += size + 2
    return out


def doc_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, block_index, text, char_start, char_end, token_estimate) of each line that is not blank; offsets count UTF-8 bytes of the lines joined by two newlines.

    Linear in the text and without a shuffle. Null texts have no rows.
    """
    names = ["block_index", "text", "char_start", "char_end", "token_estimate"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            rows = [(i, x) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for x in paragraphs(t)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), *(pa.array([x[n] for _, x in rows], pa.string() if n == "text" else pa.int64()) for n in names)], ["doc_id", *names])

    picked = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id bigint, block_index bigint, text string, char_start bigint, char_end bigint, token_estimate bigint")


def doc_chunks(docs: DataFrame, target: int = TARGET_TOKENS, overlap: int = OVERLAP_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, chunk_id, block_index, text, token_estimate, char_start, char_end): overlapping chunks of a document's paragraphs."""
    names = ["chunk_id", "block_index", "text", "token_estimate", "char_start", "char_end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            rows = [(i, x) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for x in chunk_blocks(paragraphs(t), target, overlap)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), *(pa.array([x[n] for _, x in rows], pa.string() if n == "text" else pa.int64()) for n in names)], ["doc_id", *names])

    picked = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id bigint, chunk_id bigint, block_index bigint, text string, token_estimate bigint, char_start bigint, char_end bigint")


def lm_windows(rows: DataFrame, ids_col: str, seq_length: int, bos: int = 1, eos: int = 2, pad: int = 0) -> DataFrame:
    """rows with (window_no, window) for ids_col: windows of seq_length + 1 ids over BOS + ids + EOS, seq_length apart, padded at the right.

    A window of fewer than two ids is left out. Null ids give no windows.
    """
    ids = F.concat(F.array(F.lit(bos)), F.col(ids_col).cast("array<int>"), F.array(F.lit(eos)))
    starts = F.sequence(F.lit(0), F.size(ids) - 2, F.lit(seq_length))
    cut = F.transform(starts, lambda s: F.slice(ids, s + 1, seq_length + 1))
    padded = F.transform(cut, lambda w: F.concat(w, F.array_repeat(F.lit(pad), seq_length + 1 - F.size(w))))
    others = [c for c in rows.columns if c != ids_col]
    return rows.where(F.col(ids_col).isNotNull()).select(*others, F.posexplode(padded).alias("window_no", "window"))


def inputs_and_targets(windows: DataFrame, window_col: str = "window") -> DataFrame:
    n = F.size(window_col)
    return windows.withColumn("inputs", F.slice(window_col, 1, n - 1)).withColumn("targets", F.slice(window_col, 2, n - 1))
