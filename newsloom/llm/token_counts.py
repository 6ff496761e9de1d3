"""Token counts of whole texts: batches go to the tokenizer, only lengths come back."""

from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from newsloom.llm.shared import column, on_workers

SPACE_MARK = "▁"
_MARK = SPACE_MARK.encode()


@lru_cache(maxsize=2)
def _processor(path: str):
    """The tokenizer, and whether texts may be split before single spaces: no
    piece may continue over a space, and the normaliser must leave spaces alone."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.vocab_size()))
    whole = any(SPACE_MARK in piece.lstrip(SPACE_MARK) for piece in pieces)
    probe = [model.encode(text, out_type=str) for text in (" a", "a  b", "a　b ")]
    kept = [(SPACE_MARK + text).replace(" ", SPACE_MARK) for text in (" a", "a  b", "a　b ")]
    return model, not whole and ["".join(p) for p in probe] == kept


def split_at_spaces(text: bytes, chunk_bytes: int) -> Iterator[bytes]:
    """Parts of about `chunk_bytes` whose token counts add up to the text's.

    A part ends before a space whose left neighbour is not a space. That space
    is left out: the tokenizer puts one before every text it is given. Where no
    such space follows, the part runs on.
    """
    start = 0
    while len(text) - start > chunk_bytes:
        at = text.find(b" ", start + chunk_bytes)
        while at >= 0 and (text[at - 1] == 32 or text[at - 3:at] == _MARK):
            at = text.find(b" ", at + 1)
        if at < 0 or at + 1 == len(text):
            break
        yield text[start:at]
        start = at + 1
    yield text[start:]


def counted(texts: Iterable[bytes], path: str, batch_bytes: int, chunk_bytes: int) -> list[int]:
    """Tokens of each text; parts are encoded in batches of about `batch_bytes`."""
    model, splits = _processor(path)
    counts, batch, owners, size = [], [], [], 0

    def flush():
        for owner, ids in zip(owners, model.encode(batch, num_threads=1), strict=True):
            counts[owner] += len(ids)
        batch.clear()
        owners.clear()

    for n, text in enumerate(texts):
        counts.append(0)
        for part in split_at_spaces(text, chunk_bytes) if splits else [text]:
            batch.append(part)
            owners.append(n)
            size += len(part)
            if size >= batch_bytes:
                flush()
                size = 0
    if batch:
        flush()
    return counts


def token_counts(
    df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096,
    batch_bytes: int = 1 << 20, chunk_bytes: int = 1 << 16,
) -> DataFrame:
    """One row per input row: id_col, n_bytes (UTF-8), n_tokens, over_limit
    (n_tokens > limit).

    The tokenizer's own default: no begin or end token; special strings inside a
    text are plain text. Null text counts as empty, 0 bytes and tokens; rows
    repeated, with a null id or of an empty table stay as they are; extra
    columns are left out. Texts of any length are encoded whole, in parts that
    cannot change the count.
    """
    source = df.select(column(id_col).alias("id"), F.coalesce(column(text_col), F.lit("")).cast("binary").alias("text"))
    schema = T.StructType([
        T.StructField("id", source.schema["id"].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
    ])

    def count(batches):
        for batch in batches:
            texts = [value.as_py() for value in batch["text"]]
            yield pa.RecordBatch.from_arrays([
                batch["id"], pa.array(map(len, texts), pa.int64()),
                pa.array(counted(texts, model_path, batch_bytes, chunk_bytes), pa.int64()),
            ], names=schema.names)

    rows = on_workers(source).mapInArrow(count, schema)
    return rows.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
