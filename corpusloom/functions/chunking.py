"""Overlapping chunks of consecutive blocks (pure Python, and a column form)."""

from __future__ import annotations

from typing import Any

TARGET_TOKENS, OVERLAP_TOKENS = 256, 48


def clamp(target: int, overlap: int) -> tuple[int, int]:
    target = max(1, target)
    return target, max(0, min(overlap, target - 1))


def chunk_ranges(tokens: list[int], target: int = TARGET_TOKENS, overlap: int = OVERLAP_TOKENS) -> list[tuple[int, int]]:
    """(first, last) block of each chunk.

    Blocks are taken in order until their tokens reach the target; then the chunk ends, and the next one starts with the
    shortest run of its last blocks that has the overlap's tokens (none if the overlap is 0). What is left at the end is a
    chunk too, even if it is overlap alone.
    """
    target, overlap = clamp(target, overlap)
    out: list[tuple[int, int]] = []
    start, total = 0, 0
    for i, n in enumerate(tokens):
        total += n
        if total < target:
            continue
        out.append((start, i))
        start, total = i + 1, 0
        while overlap and start > out[-1][0] and total < overlap:
            start -= 1
            total += tokens[start]
    if start < len(tokens):
        out.append((start, len(tokens) - 1))
    return out


def chunk_blocks(blocks: list[dict[str, Any]], target: int = TARGET_TOKENS, overlap: int = OVERLAP_TOKENS) -> list[dict[str, Any]]:
    """Chunks of blocks: ids count from 0, offsets span their blocks, the section path is the last block's."""
    out = []
    for k, (a, b) in enumerate(chunk_ranges([x["token_estimate"] for x in blocks], target, overlap)):
        own = blocks[a : b + 1]
        out.append(
            {
                "chunk_id": k,
                "block_index": own[0]["block_index"],
                "text": "\n\n".join(x["text"] for x in own),
                "token_estimate": sum(x["token_estimate"] for x in own),
                "char_start": own[0]["char_start"],
                "char_end": own[-1]["char_end"],
                "section_path": own[-1]["section_path"],
            }
        )
    return out
