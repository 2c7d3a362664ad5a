"""Byte-level BPE with the tokenizers library over Arrow batches, and its inverse.

A text's UTF-8 bytes are mapped to printable characters one for one; the merges work on
these. Texts are split by the pattern first and each match is encoded apart, so what a match
gives is remembered, and only matches not seen before go to the library.
"""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from modelloom.llm.common import add_columns, worker_state

#: How many distinct matches a worker remembers (about 200 bytes each); frequent ones come early.
MEMO = 300_000
#: Below this character all agree on what is a letter, a number or a space; texts with later
#: characters are split by the library itself.
SAME_CLASSES_BELOW = 0x530


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and ids of a rank file: base64, a space, the id."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def recover_merges(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """For every token of two bytes or more the pair it is merged from, in order of rank.

    A token's own merge is the last one when its bytes are merged by the ranks below its own.
    """
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            pairs = [ranks.get(a + b, rank) for a, b in zip(parts, parts[1:])]
            best = min(pairs)
            if best >= rank:
                break
            i = pairs.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) == 2:
            merges.append((parts[0], parts[1]))
    return merges


def tokenizer_definition(ranks: dict[bytes, int]) -> str:
    """The library's own JSON form of the vocabulary, to be sent to the tasks."""
    from tokenizers import Tokenizer, decoders, pre_tokenizers
    from tokenizers.models import BPE

    chars = byte_characters()
    spelled = lambda token: "".join(chars[b] for b in token)
    model = BPE(
        {spelled(t): r for t, r in ranks.items()},
        [(spelled(a), spelled(b)) for a, b in recover_merges(ranks)], ignore_merges=True,
    )
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    tokenizer.decoder = decoders.ByteLevel()
    return tokenizer.to_str()


def _class(kind: str) -> str:
    """The characters of a kind (L: letters, N: numbers) up to the last that all agree on, as ranges."""
    points = [c for c in range(SAME_CLASSES_BELOW) if unicodedata.category(chr(c))[0] == kind]
    out, start = "", None
    for c, after in zip(points, [*points[1:], -1]):
        start = c if start is None else start
        if after != c + 1:
            out, start = f"{out}\\u{start:04x}-\\u{c:04x}", None
    return out


def fast_pattern(pattern: str) -> re.Pattern:
    """A pattern of the ``regex`` module for ``re``, which is twice as fast, with its classes
    spelled out; good for texts of characters below ``SAME_CLASSES_BELOW`` only."""
    inside = {r"\p{L}": _class("L"), r"\p{N}": _class("N"), r"\s": r"\t-\r \x85\xa0", r"\S": None}
    out, at, within = "", 0, False
    while at < len(pattern):
        name = next((k for k in inside if pattern.startswith(k, at)), None)
        if name == r"\S":
            out += f"[^{inside[chr(92) + 's']}]"
        elif name:
            out += inside[name] if within else f"[{inside[name]}]"
        else:
            step = 2 if pattern[at] == "\\" else 1
            within = pattern[at] == "[" or within and pattern[at] != "]"
            out += pattern[at:at + step]
            at += step
            continue
        at += len(name)
    return re.compile(out)


# fixed value: the pattern that the library's byte-level splitter has built in
BUILT_IN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class _Memo(dict):
    """Ids by match of the pattern; notes the matches it has not and gives None for them."""

    def __init__(self):
        self.missing: list[str] = []

    def __missing__(self, piece: str) -> None:
        self.missing.append(piece)


def encoder(definition: str, pattern: str, memo: int = MEMO, added: bool = False) -> Callable[[list], list[bytes]]:
    """A function from texts to their ids, packed as little-endian unsigned 32-bit integers.

    With ``added`` the definition's added tokens have their own ids where a text holds them, as the
    library gives by default; else they are text like any other.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Regex, Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.encode_special_tokens = not added
    unsplit = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)  # for what is a match already
    if pattern != BUILT_IN:
        tokenizer.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), unsplit])
    splitting = tokenizer.pre_tokenizer
    names = [token.content for token in tokenizer.get_added_tokens_decoder().values()] if added else []
    split = fast_pattern(pattern).findall
    unusual = re.compile(f"[^\\x00-{chr(SAME_CLASSES_BELOW - 1)}]").search
    known = _Memo()

    def packed(texts: list[str], splitter) -> list[bytes]:
        tokenizer.pre_tokenizer = splitter
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]

    def encode(texts: list) -> list[bytes]:
        out: list[bytes] = []
        lookup, missing = known.__getitem__, known.missing
        for at in range(0, len(texts), 64):  # bounds the matches held at once
            part = [t or "" for t in texts[at:at + 64]]
            rare = [i for i, t in enumerate(part) if any(n in t for n in names) or not t.isascii() and unusual(t)]
            whole = dict(zip(rare, packed([part[i] for i in rare], splitting))) if rare else {}
            missing.clear()
            waiting, ids = [], []
            for i, t in enumerate(part):
                if i in whole:
                    ids.append(whole[i])
                    continue
                before = len(missing)
                values = list(map(lookup, split(t)))
                if len(missing) > before:
                    waiting.append((i, values, before, len(missing)))
                    ids.append(b"")
                else:
                    ids.append(b"".join(values))
            if missing:
                new = list(set(missing))
                found = dict(zip(new, packed(new, unsplit)))
                for piece in new[:max(0, memo - len(known))]:
                    known[piece] = found[piece]
                for i, values, first, end in waiting:
                    place = -1
                    for piece in missing[first:end]:  # in the order of the gaps
                        place = values.index(None, place + 1)
                        values[place] = found[piece]
                    ids[i] = b"".join(values)
            out += ids
        return out

    return encode


def shared_encoder(definition: str, pattern: str, added: bool = False, memo: int = MEMO) -> Callable[[list], list[bytes]]:
    """The encoder of this worker process, with what it remembers from earlier tasks."""
    token = hashlib.sha256(f"{pattern}\0{added}\0{memo}\0{definition}".encode()).hexdigest()
    return worker_state(token, lambda: encoder(definition, pattern, memo, added))


def character_starts(text: str, lengths: np.ndarray) -> np.ndarray:
    """The character each token starts in, from the tokens' lengths in bytes.

    Several tokens of a character that was split share its place.
    """
    data = np.frombuffer(text.encode(), np.uint8)
    begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters begun before each byte
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else np.zeros(0, int)
    inside = (data[starts] & 0xC0) == 0x80 if len(starts) else np.zeros(0, bool)
    return (begun[starts] - inside).astype(np.int64)


def _arrays(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat).cast(kind))


def encode(
    df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", packed: bool = False, offsets: bool = False
) -> DataFrame:
    """Add ``ids`` to ``df``: the token ids of the whole text, and with ``offsets`` the character
    each token starts in, as ``starts``.

    ``ids`` is an array of int, or with ``packed`` a binary of little-endian unsigned 32-bit
    integers. Null and empty texts give no ids. Columns of those names are replaced, others
    stay; rows are independent, so repeated rows give repeated results.
    """
    definition = tokenizer_definition(ranks)
    sizes = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)

    def make():
        run = shared_encoder(definition, pattern)

        def compute(texts: list) -> dict[str, pa.Array]:
            ids = run(texts)
            out = {"ids": pa.array(ids, pa.binary())}
            split = [np.frombuffer(x, "<u4") for x in ids] if offsets or not packed else []
            if not packed:
                out["ids"] = _arrays(split, pa.int32())
            if offsets:
                out["starts"] = _arrays([character_starts(t or "", sizes[x]) for t, x in zip(texts, split)], pa.int64())
            return out

        return compute

    adds = ("ids binary" if packed else "ids array<int>") + (", starts array<bigint>" if offsets else "")
    return add_columns(df, text, make, adds)


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """Add ``decoded`` (binary) to ``df``: the bytes of the tokens, and ``decoded_text``.

    ``ids`` is an array of int or a binary as of ``encode``. A character whose tokens lie on both
    sides of a cut cannot be read; its bytes are whole in ``decoded`` and become U+FFFD in
    ``decoded_text``. Null ids decode to no bytes.
    """
    chars = byte_characters()
    spelled = {rank: "".join(chars[b] for b in token) for token, rank in ranks.items()}

    def make():
        back = {c: b for b, c in enumerate(chars)}
        table = {rank: bytes(map(back.__getitem__, s)) for rank, s in spelled.items()}

        def compute(rows: list) -> dict[str, pa.Array]:
            out = []
            for row in rows:
                row = np.frombuffer(row, "<u4").tolist() if isinstance(row, bytes) else row or []
                out.append(b"".join(map(table.__getitem__, row)))
            return {"decoded": pa.array(out, pa.binary()), "decoded_text": pa.array([x.decode(errors="replace") for x in out])}

        return compute

    return add_columns(df, ids, make, "decoded binary, decoded_text string")
