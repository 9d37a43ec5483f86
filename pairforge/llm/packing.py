"""Packing by power-of-two decomposition.

The token ids of a document, its end id included, are cut into as many full sequences as fit and
one piece for each binary digit of the rest, longest first.  A piece is a sequence of its own and
its length is a power of two, so no sequence crosses documents and none is padded.  Pieces of
one length form a bucket: the length's exponent leads ``sequence_id``, so ordering by it groups
equal lengths, and :func:`write_buckets` stores one folder for each length.

White space never enters a token of the tokenizers meant here (it is dropped before the text is
split, case is folded, and letters never join other characters), so texts are cut at white space and the
ids of each different word are kept: a word is tokenized once in a while, not each time.  Texts with separators that Python and the tokenizer
see differently are tokenized whole.

Defined cases: null text is empty and gives the end id alone; repeated rows and rows that share a
doc_id are packed each for itself; an empty table gives no piece; a very long text is tokenized whole; columns other than ``doc_id`` and ``text`` are
not carried, so none can clash.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEQUENCE = 4096
END_ID = 2
#: Words and letter runs whose ids a task keeps (about 80 MB); it starts anew beyond.
KEPT_WORDS = 400_000
#: Characters of the texts whose words are looked up together.
GROUP_CHARS = 1 << 20
#: Bytes of ids in one batch of results.
BATCH_BYTES = 8 << 20


def lengths(n: int, most: int = SEQUENCE) -> list[int]:
    """The pieces of n tokens: full sequences, then the binary digits of the rest, longest first."""
    full, rest = divmod(n, most)
    return [most] * full + [1 << k for k in range(most.bit_length() - 1, -1, -1) if rest >> k & 1]


def _ids_of(source: str):
    """A function from a list of texts to their ids as little-endian 32-bit integers, for the tokenizer
    defined by ``source``.  What it keeps goes with it at the end of a task."""
    import numpy as np

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(source)
    tokenize = tokenizer.model.tokenize
    # how the tokenizer writes bytes as characters: printable ones as they are, others from 256 on
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in printable)}
    cores: dict[str, bytes] = {}
    known: dict[str, bytes] = {}
    odd = re.compile("[\x1c-\x1f]").search

    def encode(texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    after: dict[str, bytes] = {}

    def learn(words: set[str]) -> None:
        """The ids of words: letters, in any case, and full stops and commas after them are looked up apart.
        Lower-case letters only are one token group, which the model takes without the search for groups."""
        rest: list[str] = []
        for w in words:
            core = w.rstrip(".,")
            key = core.lower()
            plain = core.isascii() or not ("\u03a3" in core or "\u0130" in core)  # these are lower-cased by context in Python
            got = cores.get(key) if plain else None
            if got is None:
                if not (plain and key.isalpha() and (key.isascii() or unicodedata.is_normalized("NFC", key))):
                    rest.append(w)
                    continue
                data = key if key.isascii() else key.encode().decode("latin-1").translate(others)
                got = cores[key] = array("I", [t.id for t in tokenize(data)]).tobytes()
            if len(core) < len(w):
                tail = w[len(core) :]
                if tail not in after:
                    after[tail] = encode([tail])[0]
                got += after[tail]
            known[w] = got
        known.update(zip(rest, encode(rest), strict=True))

    def ids(texts: list[str]) -> list[bytes]:
        split = [None if odd(t) else t.split() for t in texts]
        if len(known) + len(cores) > KEPT_WORDS:
            known.clear()
            cores.clear()
        missing = set().union(*filter(None, split)).difference(known)
        if missing:
            learn(missing)
        return [encode([t])[0] if words is None else b"".join(map(known.__getitem__, words)) for t, words in zip(texts, split, strict=True)]

    return ids


def pack(documents: DataFrame, tokenizer_path: str, most: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens,
    sequence_id, offset.  ``most`` is a power of two."""
    if most & (most - 1):
        raise ValueError("the sequence length must be a power of two")
    with open(tokenizer_path, encoding="utf-8") as f:
        source = documents.sparkSession.sparkContext.broadcast(f.read())
    long = T.LongType()
    schema = T.StructType([documents.schema["doc_id"], T.StructField("start", long), T.StructField("length", long), T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", long)])
    names = [f.name for f in schema.fields]
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _ids_of(source.value)

        def in_groups(column: pa.Array) -> Iterator[bytes]:
            group, size = [], 0
            for text in column:
                group.append(text.as_py() or "")
                size += len(group[-1])
                if size >= GROUP_CHARS:
                    yield from ids_of(group)
                    group, size = [], 0
            yield from ids_of(group)

        for batch in batches:
            doc_ids = batch.column(0)
            rows, starts, sizes, ids, totals, held = [], [], [], [], [], 0

            def flush():
                return pa.RecordBatch.from_arrays(
                    [doc_ids.take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(totals, pa.int64())], names=names
                )

            for i, one in enumerate(in_groups(batch.column(1))):
                all_ids = one + end
                n, at = len(all_ids) // 4, 0
                for size in lengths(n, most):
                    rows.append(i)
                    starts.append(at)
                    sizes.append(size)
                    ids.append(all_ids[4 * at : 4 * (at + size)])
                    totals.append(n)
                    at += size
                held += len(all_ids)
                if held >= BATCH_BYTES:
                    yield flush()
                    rows, starts, sizes, ids, totals, held = [], [], [], [], [], 0
            if rows:
                yield flush()

    pieces = documents.select("doc_id", "text").mapInArrow(cut, schema)
    exponent = F.round(F.log2("length")).cast("long")
    sequence = F.shiftleft(exponent, 58) + F.monotonically_increasing_id()
    return pieces.withColumn("sequence_id", sequence).withColumn("offset", F.lit(0).cast("long"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The pieces as Parquet, one folder for each length."""
    pieces.withColumn("bucket", F.col("length")).write.partitionBy("bucket").parquet(path)
