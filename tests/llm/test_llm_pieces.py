"""A piece is encoded by the table of its prefixes, without the table that appends and edits need."""

from __future__ import annotations

import random

import public_tokenizers
import pytest

from starmart.llm import byte_bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_pieces_need_no_table_to_edit(monkeypatch):
    bpe = byte_bpe.ByteBpe(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    draw = random.Random(5)
    pieces = [bytes(draw.choice(b"aeinst the-1\xc3\xa9\xf0\x9f\xff\x00") for _ in range(draw.randrange(0, 60))) for _ in range(2000)]
    pieces += [b"", b"a", b"x" * 5000, "Zürichбега".encode() * 40]
    want = [bpe._merged(p) if p not in bpe.ranks else [bpe.ranks[p]] for p in pieces]
    assert [byte_bpe.PrefixTable(bpe, p).ids() for p in pieces if p not in bpe.ranks] == [w for p, w in zip(pieces, want) if p not in bpe.ranks]
    monkeypatch.setattr(byte_bpe, "PrefixTable", lambda *a: pytest.fail("a table was built"))
    assert [bpe.encode_piece(p) for p in pieces] == want
