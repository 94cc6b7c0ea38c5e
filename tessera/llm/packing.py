"""Best-fit packing of documents into fixed-length training sequences.

Three capacities bind a bin (a sequence): tokens, documents, and attention cost (the sum of
squared piece lengths). Pieces come in decreasing length; of the open bins that can take the
piece under every constraint, the one with the largest weighted dot product of its residual
capacities and the piece's demands, or the smallest norm of what would be left, takes it
(``measure``); else a bin opens.

Plan: one pass tokenises whole texts inside Arrow batches and emits one narrow row per piece
(lengths and a checksum, no ids). Pieces are dealt by hash into groups of about ``group_pieces``
and each group is packed by itself: tasks have bounded input whatever one source holds, and the
price is at most one part-filled bin or two per group.

Only distinct letter runs of a batch go through the tokenizer library; runs are cut where the
vocabulary's own pre-tokenizer always cuts (white space; between an ASCII letter and ASCII
punctuation), so ids equal those of the whole text.

Cases: null text is empty (its ids are the final id 0 alone); longer documents are cut into
``capacity`` pieces; equal rows are packed each for itself; a null doc_id is carried along;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, ascii_lower_bytes, cut_strings, released, slices, text_bytes

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_PUNCT = np.array([33 <= c < 127 and not chr(c).isalnum() for c in range(256)])
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


#: Text bytes tokenised at once: distinct runs are encoded once for all of them.
ENCODE_BYTES = 6 << 20


@dataclass(frozen=True)
class PackConfig:
    tokenizer: str | None = None        # path of the tokenizer file; None: the public word_bpe_49k
    capacity: int = 2048                # tokens of a sequence
    max_documents: int | None = None    # pieces of a sequence; None: as many as fit
    max_cost: int | None = None         # sum of squared piece lengths; None: capacity ** 2
    weights: tuple[float, float, float] = (1.0, 0.05, 0.2)   # tokens, documents, cost
    measure: str = "norm"               # "norm" or "dot"
    group_pieces: int = 8192
    end_id: int = 0


def tokenizer_path(cfg: PackConfig) -> str:
    if cfg.tokenizer:
        return cfg.tokenizer
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


_LOADED: dict[str, tuple] = {}


def load(path: str):
    """(tokenizer, flags of the ids that end a word, special strings); once per Python process."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        vocab = tok.get_vocab(with_added_tokens=True)
        ends = np.zeros(max(vocab.values()) + 1, bool)
        for word, i in vocab.items():
            ends[i] = word.endswith("</w>")
        special = [t.content.encode() for t in tok.get_added_tokens_decoder().values()]
        _LOADED[path] = (tok, ends, special)
    return _LOADED[path]


def encode_runs(runs: list[str], tok, ends) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each run and their offsets.

    Runs of ASCII letters are one word each, so many can be encoded as one text and told apart by the
    ids that end a word; other runs are encoded one by one.
    """
    plain = [i for i, r in enumerate(runs) if r.isascii() and r.isalpha()]
    lengths = np.zeros(len(runs), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []          # (run indices, ids in their order)
    for at in range(0, len(plain), 20000):
        mine = plain[at:at + 20000]
        texts = [" ".join(runs[i] for i in mine[k:k + 500]) for k in range(0, len(mine), 500)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in tok.encode_batch_fast(texts, add_special_tokens=False)])
        stop = np.flatnonzero(ends[ids]) + 1
        if len(stop) != len(mine):
            raise ValueError("this vocabulary does not mark word ends")
        lengths[mine] = np.diff(np.concatenate([[0], stop]))
        parts.append((np.array(mine), ids))
    plain_set = np.zeros(len(runs), bool)
    plain_set[plain] = True
    other = np.flatnonzero(~plain_set)
    for at in range(0, len(other), 20000):
        mine = other[at:at + 20000]
        made = [e.ids for e in tok.encode_batch_fast([runs[i] for i in mine], add_special_tokens=False)]
        lengths[mine] = [len(x) for x in made]
        parts.append((mine, np.array([y for x in made for y in x], np.uint32)))
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.zeros(offsets[-1], np.uint32)
    for mine, ids in parts:
        flat[ranges(offsets[mine], lengths[mine])] = ids
    return flat, offsets


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The concatenation of ``start[i] .. start[i] + length[i] - 1``."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total and max(total, int(start.max()) + total) < 1 << 31 else np.int64
    out = np.repeat((start - (ends - length)).astype(kind), length)
    out += np.arange(total, dtype=kind)
    return out


def has_any(data: np.ndarray, strings: list[bytes]) -> bool:
    """Does the text hold one of the strings?"""
    whole = data.tobytes()
    return any(s in whole for s in strings)


def token_ids(texts: pa.Array, tokenizer) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows (no final id) and row offsets."""
    tok, ends, special = tokenizer
    data, off = text_bytes(texts)
    keep = ~_BLANK[data]
    starts = keep.copy()
    if has_any(data, special):
        starts[1:] &= ~keep[:-1]
    else:
        data = ascii_lower_bytes(data)                          # the vocabulary is lower case
        letter, punct = _LETTER[data], _PUNCT[data]
        cut = ~keep[:-1]
        cut |= letter[:-1] & punct[1:]
        cut |= punct[:-1] & (data[:-1] != 39) & letter[1:]      # an apostrophe may start a contraction
        starts[1:] &= cut
        del letter, punct, cut
    first = off[:-1][off[:-1] < off[1:]]
    starts[first] = keep[first]
    # a Python worker's peak is here: what is a number a byte or a run goes as soon as it is used
    pos, strings = cut_strings(data, starts, keep)
    row = np.searchsorted(pos, off)
    del data, keep, starts, pos
    encoded = strings.dictionary_encode()
    del strings
    codes, runs = np.asarray(encoded.indices), encoded.dictionary.to_pylist()
    flat, offsets = encode_runs(runs, tok, ends)
    del encoded, runs
    if not len(codes):
        return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
    lengths = np.diff(offsets)[codes]
    per_run = np.concatenate([[0], np.cumsum(lengths)])[row]
    return flat[ranges(offsets[codes], lengths)], per_run


def pieces(documents: DataFrame, cfg: PackConfig = PackConfig()) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document: at most ``capacity`` tokens each."""
    path = tokenizer_path(cfg)

    def cut(batches):
        tokenizer = load(path)
        for batch in batches:
            for part in slices(batch, limit=ENCODE_BYTES):
                ids, offsets = token_ids(part.column("text"), tokenizer)
                doc, piece, start, length, crc = [], [], [], [], []
                for i in range(part.num_rows):
                    mine = np.append(ids[offsets[i]:offsets[i + 1]], np.uint32(cfg.end_id)).astype("<u4")
                    for k, at in enumerate(range(0, len(mine), cfg.capacity)):
                        some = mine[at:at + cfg.capacity]
                        doc.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(len(some))
                        crc.append(zlib.crc32(some.tobytes()))
                yield pa.record_batch([part.column("doc_id").take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()),
                                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                                      names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        released(cut), "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, cfg: PackConfig = PackConfig()) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of pieces given in decreasing length."""
    caps = np.array([cfg.capacity, cfg.max_documents or cfg.capacity, cfg.max_cost or cfg.capacity ** 2], np.float64)
    w = np.array(cfg.weights)
    smallest = int(lengths.min()) if len(lengths) else 0
    left = np.empty((3, max(16, len(lengths))))        # residual capacities of the open bins
    name = np.empty(left.shape[1], np.int64)
    fill = np.zeros(len(lengths), np.int64)            # tokens in each bin
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    n_open = n_bins = 0
    for i, size in enumerate(lengths):
        need = np.array([size, 1.0, float(size) ** 2])
        at = -1
        if n_open:
            room = left[:, :n_open]
            fits = np.flatnonzero(room[0] >= size)
            if len(fits):
                after = room[:, fits] - need[:, None]
                ok = (after[1] >= 0) & (after[2] >= 0)
                share = after / caps[:, None]
                value = -(w @ (share * share)) if cfg.measure == "norm" else w @ (room[:, fits] / caps[:, None] * (need / caps)[:, None])
                value[~ok] = -np.inf
                best = int(value.argmax())
                if ok[best]:
                    at = int(fits[best])
        if at < 0:
            at, n_open, n_bins = n_open, n_open + 1, n_bins + 1
            left[:, at], name[at] = caps, n_bins - 1
        b = name[at]
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        left[:, at] -= need
        if left[0, at] < smallest or left[1, at] < 1 or left[2, at] < smallest ** 2:
            n_open -= 1                                 # full: the last open bin takes its slot
            left[:, at], name[at] = left[:, n_open], name[n_open]
    return bins, offsets


def pack(documents: DataFrame, cfg: PackConfig = PackConfig()) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    if cfg.max_cost is not None and cfg.max_cost < cfg.capacity ** 2:
        raise ValueError("max_cost must hold one full piece")
    scratch = Scratch(documents.sparkSession)
    rows = scratch.write(pieces(documents, cfg), "pieces")
    groups = max(1, -(-rows.count() // cfg.group_pieces))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("int"))

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                               ("ids_crc32", "ascending")])
        bins, offsets = best_fit(np.asarray(table.column("length")), cfg)
        part = table.column("part")[0].as_py()
        return table.drop_columns(["part"]).append_column("sequence_id", pa.array((part << 32) + bins)) \
            .append_column("offset", pa.array(offsets))

    return dealt.groupBy("part").applyInArrow(
        fill, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
