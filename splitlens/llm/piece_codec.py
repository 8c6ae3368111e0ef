"""SentencePiece encoding and decoding through a table of distinct chunks.

The model writes a space as a marker.  Where no piece has a marker behind
another character, no merge can cross from a word into the next marker, so a text splits
into chunks -- a run of markers and the characters up to the next run -- that
encode independently.  Per batch of documents the distinct chunks are found, each is
segmented (and decoded) once, and ids and text are joined back by position.  What a task
has segmented it remembers for its next batches, up to a bound in characters; chunks of over
``LONG`` characters -- whole texts, in languages without blanks -- are dropped with their batch.

The table stays inside the task: a corpus-wide one would send every position of every
text through a shuffle, many times the input, to spare the repeated segmenting of a chunk in
several tasks.

Defined results: a NULL text counts as empty; an empty text has no piece, only the end id,
and decodes to the empty text; a marker character in the text itself counts as
a space, as in the library; repeated rows get a row each; an empty table gives an empty
result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlens.llm.common import ship_by_value

ship_by_value(__name__)

MARK = "▁"
REMEMBERED = 1 << 25        # characters of chunks a task remembers before it starts anew
LONG = 256                  # longer chunks are segmented where they occur and not remembered
PART_ROWS, PART_CHARS = 512, 1 << 22        # rows and characters handled at a time


def splits_at_marks(model: bytes) -> bool:
    """True where chunks are independent: BPE pieces with markers only in front, an
    identity normalizer that keeps blanks and adds a marker in front, a piece for the marker
    itself, and no user-defined pieces."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto.FromString(model)
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
    return (spec.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
            and spec.normalizer_spec.name == "identity" and spec.normalizer_spec.add_dummy_prefix
            and not spec.normalizer_spec.remove_extra_whitespaces and spec.normalizer_spec.escape_whitespaces
            and not spec.trainer_spec.treat_whitespace_as_suffix
            and not any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in spec.pieces)
            and not any(MARK in p.piece.lstrip(MARK) for p in spec.pieces)
            and sp.piece_to_id(MARK) != sp.unk_id())


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  keep: bool = False) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_tokens`` (with the end id),
    ``ids_sha256``, ``decoded_sha256``; with ``keep`` also the ``ids`` and
    the ``decoded`` text."""
    with open(path, "rb") as f:
        raw = f.read()
    if not splits_at_marks(raw):
        raise ValueError("pieces of this model may cross whitespace markers")
    model = docs.sparkSession.sparkContext.broadcast(raw)

    def run(batches):
        import hashlib
        import re

        import pyarrow.compute  # noqa: F401 - pa.compute
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model.value)
        chunks_of = re.compile(f"{MARK}+[^{MARK}]*").findall
        mark, end = sp.piece_to_id(MARK), sp.eos_id()
        first = next(i for i in range(sp.get_piece_size()) if sp.id_to_piece(i) == f"{MARK}a")
        table = {}                      # chunk -> (number of ids, their decimals, decoded text)
        held = 0                        # characters in the table

        def learn(chunks):
            """The entries of ``chunks``; those that the table lacks are segmented."""
            nonlocal held
            if held > REMEMBERED:
                table.clear()
                held = 0
            entries = {c: table[c] for c in chunks if c in table}
            new = [c for c in chunks if c not in entries]
            # The library puts one marker in front by itself; a lone marker is its own piece.
            ids = [i or [mark] for i in sp.encode([c[1:] for c in new], num_threads=1)]
            # Behind another piece a chunk keeps its leading blank when it is decoded.
            texts = sp.decode([[first, *i] for i in ids], num_threads=1) if new else []
            for c, i, t in zip(new, ids, texts):
                entries[c] = entry = (len(i), "".join([f"{x} " for x in i]), t[1:])
                if len(c) <= LONG:
                    table[c] = entry
                    held += len(c)
            return entries

        def parts(batch):
            """Slices of a batch by rows and characters."""
            start = size = 0
            for k, n in enumerate(pa.compute.utf8_length(batch.column(1)).to_pylist()):
                if k > start and (k - start >= PART_ROWS or size + (n or 0) > PART_CHARS):
                    yield batch.slice(start, k - start)
                    start, size = k, 0
                size += n or 0
            if batch.num_rows > start:
                yield batch.slice(start)

        def one(text):
            chunks = chunks_of(MARK + text.replace(" ", MARK)) if text else []
            return chunks

        for batch in batches:
            for part in parts(batch):
                split = [one(t.as_py() or "") for t in part.column(1)]
                distinct = set()
                for chunks in split:
                    distinct.update(chunks)
                entries = learn(distinct)
                out = []
                for chunks in split:
                    rows = [entries[c] for c in chunks]
                    ids = "".join([r[1] for r in rows]) + str(end)
                    # The marker that the encoder put in front is taken off again.
                    text = "".join([r[2] for r in rows])[1:]
                    out.append((sum([r[0] for r in rows]) + 1, hashlib.sha256(ids.encode()).hexdigest(),
                                hashlib.sha256(text.encode()).hexdigest(), ids if keep else None, text if keep else None))
                cols = list(zip(*out)) if out else [[]] * 5
                arrays = [part.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep:
                    arrays += [pa.array([[int(x) for x in i.split(" ")] for i in cols[3]], pa.list_(pa.int32())), pa.array(cols[4], pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    kind = dict(docs.dtypes)[id_col]
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    done = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, schema + (", ids array<int>, decoded string" if keep else ""))
    return done.withColumnRenamed("id", id_col)
