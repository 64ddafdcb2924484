"""Language-model scores: the likelihood of texts over all their segmentations into pieces.

A text is a row of words and an end. A word's probability is the sum over all ways to build it
from pieces of an existing subword vocabulary. The pieces start with the vocabulary's own scores,
and expected counts over the training words refine them. A second score takes a word that training
texts hold as one piece more; the weight of such whole words is the one that makes each training
word likeliest when that one occurrence of it is left out.

No task and no driver holds the corpus's words. Texts are packed into chunks of bounded size;
a chunk asks for the counts and likelihoods of its different words, a join on the word answers,
and the answers travel back to the chunk, where its texts are scored.
"""

import math
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from orderloom.llm.lattice import Lattice, load_pieces
from orderloom.llm.text import parts, reachable
from orderloom.session import cut_lineage

#: Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 16 << 20
#: Chunks that a task scores on average, one after the other, where there are many.
TASK_CHUNKS = 4
#: Rounds in which expected counts refine the pieces' probabilities.
ROUNDS = 2
#: Candidates for the weight of whole words.
WEIGHTS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 0.99)


def pack(df: DataFrame, learn, key="doc_id", text="text", chunk_bytes=CHUNK_BYTES) -> DataFrame:
    """The rows of `df` in chunks: chunk (an id), keys, learn (whether a row is learned from; the
    column `learn` says so), sizes (bytes) and body (the texts one after the other, compressed).
    Written to the shared folder, as chunk ids are drawn anew whenever a task runs."""
    reachable(df.sparkSession)
    schema = StructType([
        StructField("chunk", LongType()), StructField("keys", ArrayType(df.schema[key].dataType)),
        StructField("learn", ArrayType(BooleanType())),
        StructField("sizes", ArrayType(IntegerType())), StructField("body", BinaryType())])
    arrow = to_arrow_schema(schema)

    def chunk(rows):
        texts = [t for _, _, t in rows]
        body = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
        values = [uuid.uuid4().int >> 65, [k for k, _, _ in rows], [f for _, f, _ in rows],
                  [len(t) for t in texts], body]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], type=f.type) for v, f in zip(values, arrow, strict=True)],
            schema=arrow)

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for part in parts(batch, 2):
                for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    data = (row[2] or "").encode()
                    if rows and size + len(data) > chunk_bytes:
                        yield chunk(rows)
                        rows, size = [], 0
                    rows.append((row[0], row[1], data))
                    size += len(data)
        if rows:
            yield chunk(rows)

    return cut_lineage(df.select(key, learn.alias("learn"), text).mapInArrow(run, schema),
                       "lm-chunks")


def _texts(sizes, body):
    """The words of each text of a chunk, A-Z in lower case."""
    data, low = zstandard.ZstdDecompressor().decompress(body).lower(), 0
    for size in sizes:
        yield data[low:low + size].split()
        low += size


def chunk_words(chunks: DataFrame) -> DataFrame:
    """(word, chunk, n): each different word of a chunk, and how often its training texts hold
    it."""

    def run(batches):
        for batch in batches:
            for chunk, _, learn, sizes, body in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                counts, others = Counter(), set()
                for words, learned in zip(_texts(sizes, body), learn, strict=True):
                    if learned:
                        counts.update(words)
                    else:
                        others.update(words)
                for word in others:
                    counts.setdefault(word, 0)
                for rows in _slices(counts):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([w for w, _ in rows], pa.binary()),
                         pa.array([chunk] * len(rows), pa.int64()),
                         pa.array([n for _, n in rows], pa.int64())],
                        names=["word", "chunk", "n"])

    return chunks.select("chunk", "keys", "learn", "sizes", "body").mapInArrow(
        run, "word binary, chunk long, n long")


def _slices(counts, size=50_000):
    rows = list(counts.items())
    for low in range(0, len(rows), size):
        yield rows[low:low + size]


def refine(words: DataFrame, pieces, log_p, rounds=ROUNDS):
    """Log probabilities of the pieces from their expected counts in the training words, plus a
    tenth each. A round sends one number per piece and task, added up before it reaches the
    driver."""
    known = words.where("c > 0").select("word", "c")
    for _ in range(rounds):
        found = known.mapInArrow(_expecting(pieces, log_p), "piece int, times double")
        counts = np.full(len(pieces), 0.1)
        for piece, times in found.groupBy("piece").agg(F.sum("times")).collect():
            counts[piece] += times
        if counts.sum() <= 0.1 * len(pieces):
            break
        log_p = np.log(counts / counts.sum())
    return log_p


def _expecting(pieces, log_p):
    def run(batches):
        lattice, total = Lattice(pieces, log_p), np.zeros(len(pieces))
        for batch in batches:
            total += lattice.expected_counts(
                batch.column(0).to_pylist(), batch.column(1).to_numpy().astype(float))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(total[used])], names=["piece", "times"])

    return run


def spell(words: DataFrame, pieces, log_p) -> DataFrame:
    """`words` (word, c) with log_p, the natural logarithm of the probability that pieces spell
    the word."""

    def run(batches):
        lattice = Lattice(pieces, log_p)
        for batch in batches:
            found = lattice.log_probabilities(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found)], names=["word", "c", "log_p"])

    return words.select("word", "c").mapInArrow(run, "word binary, c long, log_p double")


def whole_word_weight(spelled: DataFrame, n_words: int) -> float:
    """The weight of whole words under which the training words are likeliest, each occurrence
    scored by the counts of the others; one pass for all candidates."""
    if n_words < 2:
        return 0.0
    others = (F.col("c") - 1) / (n_words - 1)
    sums = spelled.where("c > 0").agg(*(
        F.sum(F.col("c") * F.log(F.greatest(
            others * w + F.exp("log_p") * (1 - w), F.lit(1e-300)))) for w in WEIGHTS)).first()
    return max(zip(sums, WEIGHTS, strict=True))[1]


def score(df: DataFrame, learn, vocabulary: str, key="doc_id", text="text",
          chunk_bytes=CHUNK_BYTES, rounds=ROUNDS) -> DataFrame:
    """`key` and the scores of every whole text: n_tokens (words and one end), n_known (those in
    training texts), train_tokens, base_score (smoothed counts of whole words), score (the sum over
    all segmentations into pieces) and word_score (the same with whole words as further pieces),
    logarithms to base 10.

    `learn` is a boolean column: which rows to learn from. `vocabulary` is the path of a
    sentencepiece model on the driver. A null text is an empty one: an end. Repeated rows are
    scored each. An empty table gives no rows; without training rows the base score of a token
    is log10(1) and words are spelled with the vocabulary's own scores. Other columns of `df`
    are ignored.
    """
    chunks = pack(df, learn, key, text, chunk_bytes)
    asked = chunk_words(chunks)
    words = cut_lineage(asked.groupBy("word").agg(F.sum("n").alias("c")), "lm-words")
    sums = words.where("c > 0").agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    ends = chunks.agg(F.coalesce(F.sum(F.size(F.filter("learn", lambda x: x))), F.lit(0)))
    n_ends = ends.first()[0]
    n_different, n_words = sums[0] + (n_ends > 0), sums[1]
    pieces, log_p = load_pieces(vocabulary)
    log_p = refine(words, pieces, log_p, rounds)
    spelled = cut_lineage(spell(words, pieces, log_p), "lm-spelled")
    weight = whole_word_weight(spelled, n_words)
    answers = asked.select("word", "chunk").join(spelled, "word").select(
        "chunk", "word", "c", "log_p")
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                -(-chunks.count() // TASK_CHUNKS))
    chunks, answers = (side.repartition(tasks, "chunk") for side in (chunks, answers))
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _scoring(n_words, n_ends, n_different, weight, df.schema[key]),
        StructType([df.schema[key], *_SCORES]))


_SCORES = [StructField("n_tokens", LongType()), StructField("n_known", LongType()),
           StructField("train_tokens", LongType()), StructField("base_score", DoubleType()),
           StructField("score", DoubleType()), StructField("word_score", DoubleType())]


def _scoring(n_words, n_ends, n_different, weight, key_field):
    schema = to_arrow_schema(StructType([key_field, *_SCORES]))
    n_all = n_words + n_ends
    floor = n_all + 0.1 * (n_different + 1)
    p_end = (n_ends + 0.1) / (n_all + 0.2)

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return schema.empty_table()
        place = {w: i for i, w in enumerate(answers.column("word").to_pylist())}
        c = answers.column("c").to_numpy().astype(float)
        base = np.log10((c + 0.1) / floor)
        spelled = answers.column("log_p").to_numpy()
        with np.errstate(divide="ignore"):
            whole = np.log(weight * c / max(n_words, 1))
            mixed = np.logaddexp(whole, np.log(1 - weight) + spelled)
        spelled, mixed = ((x + math.log1p(-p_end)) / math.log(10) for x in (spelled, mixed))
        base_end, end = math.log10((n_ends + 0.1) / floor), math.log10(p_end)
        known = c > 0
        rows = []
        for words in _texts(chunk.column("sizes")[0].as_py(), chunk.column("body")[0].as_py()):
            at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
            rows.append((len(words) + 1, int(known[at].sum()) + (n_ends > 0), n_all,
                         float(base[at].sum()) + base_end, float(spelled[at].sum()) + end,
                         float(mixed[at].sum()) + end))
        keys = chunk.column("keys")[0].as_py()
        return pa.Table.from_arrays(
            [pa.array(keys, schema.field(0).type),
             *(pa.array([r[i] for r in rows], schema.field(i + 1).type)
               for i in range(len(_SCORES)))],
            schema=schema)

    return run
