"""Token ids of whole texts by a public byte-level BPE vocabulary.

The vocabulary file (of the ``tokenizers`` library) is a parameter; by default
the installed public one is looked up in the task.  Its rank file holds the
same vocabulary for a faster library: texts of printable Latin-1, whose
character classes never change, are encoded by that one, all other texts and
those with an added token's string by the tokenizer itself.  Both give the same
ids (tested).
"""

from __future__ import annotations

import base64
import os
import re
import struct

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
DEFAULT_RANKS = "byte_bpe_50k.tiktoken"
_PLAIN = re.compile("[\t\n !-~¡-¬®-ÿ]*").fullmatch
_OPEN: dict[str, TokenIds] = {}


class TokenIds:
    """Ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as f:
                by_bytes = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
            self._fast = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=by_bytes, special_tokens={})

    def _ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self._fast and _PLAIN(text) and not any(t in text for t in self._added):
            return self._fast.encode_ordinary(text)
        return self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return [struct.pack(f"<{len(i)}I", *i) for i in map(self._ids, texts)]


def token_ids(path: str | None = None) -> TokenIds:
    """The encoder of a vocabulary file, opened once per Python worker."""
    key = path or DEFAULT_VOCABULARY
    if key not in _OPEN:
        if path is None:
            import public_tokenizers as public

            _OPEN[key] = TokenIds(public.path(DEFAULT_VOCABULARY), public.path(DEFAULT_RANKS), public.PATTERN)
        else:
            _OPEN[key] = TokenIds(path)
    return _OPEN[key]


def largest_id(path: str | None = None) -> int:
    """The largest id of a vocabulary file, added tokens included."""
    return max(token_ids(path)._tokenizer.get_vocab(with_added_tokens=True).values())
