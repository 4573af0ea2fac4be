"""Token ids of a public tokenizer file, at worker side, one loaded copy per Python process."""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

#: Fixed values of the byte-level BPE pre-tokenizer (its published split pattern).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The faster library backtracks over white space and overflows its stack on very long runs; texts that hold one as long
#: as this are encoded by the file's own library.
LONG_SPACE = re.compile(r"(?<!\s)\s{2000}")
PROBE = "It's  a\tprobe:\n\n 12 naïve cafés — 東京 'll  <|endoftext|> x\u0085y  "


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write byte b as chr(b) where that prints, else as the next free of chr(256)..."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {chr(b) if b in plain else chr(next(spare)): b for b in range(256)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function from text to ids as an ``array('I')``: those of the file's tokenizer, without special tokens added.

    Plain byte-level BPE files whose ids follow their merge order also run in the faster of the two installed BPE
    libraries, with the same vocabulary; the file's own library encodes a probe text to confirm it, and is used
    for all other files and for texts with a very long run of white space.
    """
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    slow = lambda text: array("I", own.encode(text, add_special_tokens=False).ids)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec.get("model", {}), spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer")
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        and all(t["special"] and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec.get("added_tokens", []))
    )
    vocab = model.get("vocab", {})
    pairs = (m if isinstance(m, list) else m.split(" ") for m in model.get("merges", []))
    if not plain or any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
        return slow
    import tiktoken

    byte = _byte_of_char()
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if token not in special}
    fast = tiktoken.Encoding("byte_level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=special)
    names = set(special)
    if fast.encode(PROBE, allowed_special=names) != list(slow(PROBE)):
        return slow

    def encode(text: str) -> array:
        if LONG_SPACE.search(text):
            return slow(text)
        hit = any(s in text for s in names)
        return array("I", fast.encode(text, allowed_special=names) if hit else fast.encode_ordinary(text))

    return encode


def pieces_of(n: int, cap: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else the remainder first and then full ones."""
    first = n % cap or cap
    cuts = [0, *range(first, n + 1, cap)] if n > cap else [0, n]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]
