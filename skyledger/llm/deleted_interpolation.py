"""Language-model scores by deleted interpolation of n-gram estimates.

The probability of a word is a mixture of its maximum-likelihood estimates as a bigram, as a unigram, and of a uniform one. The
weights depend on how often the context was seen (buckets of powers of two) and are learned by expectation-maximisation on
counts of a part of the training documents that is deleted from the estimates meanwhile. The final estimates use all of them.

Counts are summed by a packed exchange (see ``exchange``): a block of documents sends each bucket its n-grams and counts, and the
bucket answers each block with the totals of just these. Nothing is looked up in a table that one machine holds, and a word of a
third of the corpus is one entry per block. A unigram is known by a 64-bit hash; a bigram by its bucket and 40 further bits, which
makes one in a million collide at any corpus size, as a bucket is of bounded size.

The driver gets two totals, and for the weights a histogram over quantised probabilities, whose size is bounded by its grid.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import exchange
from skyledger.llm.common import NULL_ID, stored
from skyledger.llm.rolling import Words, mixed

U = np.uint64
START, END = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F)  # stand before and behind every text
UNSEEN, TRAINING, DELETED = 0, 1, 2
LEVELS = 40  # context buckets: 0, then powers of two
GRID = 8  # steps per nat in the histogram
DEFAULT = (0.5, 0.4, 0.1)
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SENT = ["words", "word_counts", "word_deleted", "pairs", "pair_counts", "pair_deleted"]
ANSWER = "bucket int, block int, words binary, words_deleted binary, pairs binary, pairs_deleted binary, vocabulary long, total long"
_ANSWER = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), *[(n, pa.binary()) for n in ("words", "words_deleted", "pairs", "pairs_deleted")],
                     ("vocabulary", pa.int64()), ("total", pa.int64())])


@dataclass
class Tokens:
    """All tokens of some documents: ``word`` hashes, the end of each text among them, and the pair with the token before.

    ``first`` is where each text starts; the token before it is the start mark.
    """
    word: np.ndarray
    pair: np.ndarray
    first: np.ndarray
    lengths: np.ndarray

    def __init__(self, texts: list[str]):
        words, lengths = [], []
        for text in texts:
            own = text.encode().translate(_FOLD).split()
            words += own
            lengths.append(len(own) + 1)
        self.lengths = np.array(lengths, dtype=np.int64)
        ends = np.cumsum(self.lengths) - 1
        self.word = np.full(int(self.lengths.sum()), END)
        inner = np.ones(len(self.word), dtype=bool)
        inner[ends] = False
        self.word[inner] = Words(words).runs(1)
        self.first = ends + 1 - self.lengths
        context = np.roll(self.word, 1)
        context[self.first] = START
        self.pair = mixed(context * U(3) + self.word * U(0x9FB21C651E98DF25))


@dataclass
class Asked:
    """Distinct words and pairs of some tokens, where each token's are, and the deal over buckets."""

    def __init__(self, tokens: Tokens, buckets: int):
        self.words, at = np.unique(np.append(tokens.word, START), return_inverse=True)
        self.word_at, self.start_at = at[:-1], int(at[-1])
        self.context_at = np.roll(self.word_at, 1)
        self.context_at[tokens.first] = self.start_at
        self.pairs, self.pair_at = np.unique(tokens.pair, return_inverse=True)
        self.word_deal = exchange.parcels((self.words >> U(32)) % U(buckets), at=np.arange(len(self.words)))
        self.pair_deal = exchange.parcels(self.pairs % U(buckets), at=np.arange(len(self.pairs)))

    def filled(self, answers: dict[int, tuple[bytes, bytes]], words: bool) -> np.ndarray:
        """Totals per distinct word or pair from the buckets' answers."""
        out = np.zeros(len(self.words if words else self.pairs), dtype=np.int64)
        for bucket, part in self.word_deal if words else self.pair_deal:
            out[part["at"]] = exchange.whole(answers[bucket][0 if words else 1], 8)
        return out


def counts(at: np.ndarray, size: int, weight: np.ndarray) -> np.ndarray:
    return np.bincount(at, weights=weight, minlength=size).astype(np.int64)


def question(tokens: Tokens, block: int, buckets: int, role: np.ndarray) -> list[tuple[int, int, dict]]:
    """Rows for the buckets: distinct n-grams, how often each stands in training texts, and in deleted ones."""
    asked = Asked(tokens, buckets)
    each = np.repeat(role, tokens.lengths)
    made = []
    for wanted in ((each != UNSEEN), (each == DELETED)):
        # A context is counted as the word it is; the start, which is no word, once per text.
        word = counts(asked.word_at, len(asked.words), wanted)
        word[asked.start_at] = wanted[tokens.first].sum()
        made.append((word, counts(asked.pair_at, len(asked.pairs), wanted)))
    rows: dict[int, dict] = {}
    for bucket, part in asked.word_deal:
        at = part["at"]
        rows[bucket] = dict.fromkeys(SENT, b"") | {"words": exchange.planes(asked.words[at]), "word_counts": exchange.planes(made[0][0][at]), "word_deleted": exchange.planes(made[1][0][at])}
    for bucket, part in asked.pair_deal:
        at = part["at"]
        rows.setdefault(bucket, dict.fromkeys(SENT, b"")).update(
            pairs=exchange.narrow(asked.pairs[at] >> U(24), 5), pair_counts=exchange.planes(made[0][1][at]), pair_deleted=exchange.planes(made[1][1][at]))
    return [(bucket, block, row) for bucket, row in rows.items()]


def questions(blocks: int):
    """Step 1, per block: its n-grams; those of its deleted texts once more under a number of their own, for the weights."""
    def run(key, table):
        block, role = key[0].as_py(), np.array(table.column("role").to_pylist(), dtype=np.int64)
        texts = table.column("text").to_pylist()
        sent = question(Tokens(texts), block, blocks, role)
        deleted = [text for text, r in zip(texts, role, strict=True) if r == DELETED]
        if deleted:
            sent += question(Tokens(deleted), blocks + block, blocks, np.full(len(deleted), UNSEEN))
        return exchange.letters(sent, SENT)
    return run


def totals(blocks: int):
    """Step 2, per bucket: sums over all blocks, answered in the order of each block's question."""
    def run(key, table):
        got = {name: [x.as_py() for x in table.column(name)] for name in SENT}
        block = table.column("block").to_pylist()
        out = {"bucket": [key[0].as_py()] * len(block), "block": block, "vocabulary": [0] * len(block), "total": [0] * len(block)}
        for kind, width in (("word", 8), ("pair", 5)):
            keys = [exchange.whole(x, width) for x in got[f"{kind}s"]]
            cuts = np.cumsum([len(x) for x in keys])[:-1]
            values, at = np.unique(np.concatenate(keys), return_inverse=True)
            for which in ("counts", "deleted"):
                each = np.concatenate([exchange.whole(x, 8) for x in got[f"{kind}_{which}"]]).astype(np.int64)
                sums = counts(at, len(values), each)
                answer = [exchange.planes(x) for x in np.split(sums[at], cuts)]
                if which == "counts":
                    out[f"{kind}s"] = answer
                    if kind == "word":
                        real = values != START
                        out["vocabulary"][0], out["total"][0] = int((sums[real] > 0).sum()), int(sums[real].sum())
                else:
                    out[f"{kind}s_deleted"] = [x if b >= blocks else b"" for x, b in zip(answer, block, strict=True)]
        return pa.table(out, schema=_ANSWER)
    return run


def replies_of(table: pa.Table, suffix: str = "") -> dict[int, tuple[bytes, bytes]]:
    columns = (table.column(name).to_pylist() for name in ("bucket", f"words{suffix}", f"pairs{suffix}"))
    return {bucket: (words, pairs) for bucket, words, pairs in zip(*columns, strict=True)}


def level(context: np.ndarray) -> np.ndarray:
    """Bucket of a context count: 0 for none, then one per power of two."""
    return np.minimum(np.log2(np.maximum(context, 0.5)).astype(np.int64) + 1, LEVELS - 1) * (context > 0)


def ratio(a: np.ndarray, b) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=np.broadcast_to(b, a.shape) > 0)


def quantised(p: np.ndarray) -> np.ndarray:
    """Steps below probability 1, or -1 for probability 0."""
    return np.where(p > 0, np.round(-np.log(np.maximum(p, 1e-30)) * GRID), -1).astype(np.int64)


def evidence(blocks: int, total: int, deleted_total: int):
    """Step 3, per block: how often each (context bucket, bigram, unigram estimate) meets a deleted token."""
    schema = pa.schema([("level", pa.int64()), ("pair", pa.int64()), ("word", pa.int64()), ("n", pa.int64())])

    def run(key, table, replies):
        if not table.num_rows:
            return pa.table([[]] * 4, schema=schema)
        tokens = Tokens(table.column("text").to_pylist())
        asked = Asked(tokens, blocks)
        rest = {}
        for words in (True, False):
            rest[words] = asked.filled(replies_of(replies), words) - asked.filled(replies_of(replies, "_deleted"), words)
        context = rest[True][asked.context_at]
        cells = np.stack((level(context), quantised(ratio(rest[False][asked.pair_at], context)),
                          quantised(ratio(rest[True][asked.word_at], total - deleted_total))), axis=1)
        cells, n = np.unique(cells, axis=0, return_counts=True)
        return pa.table([pa.array(cells[:, 0]), pa.array(cells[:, 1]), pa.array(cells[:, 2]), pa.array(n)], schema=schema)
    return run


def weights(cells: np.ndarray, vocabulary: int, rounds: int = 60) -> np.ndarray:
    """Mixture weights (bigram, unigram, uniform) per context bucket by expectation-maximisation on the histogram."""
    mix = np.tile(np.array(DEFAULT), (LEVELS, 1))
    mix[0] = (0, DEFAULT[1] / (DEFAULT[1] + DEFAULT[2]), DEFAULT[2] / (DEFAULT[1] + DEFAULT[2]))
    if not len(cells):
        return mix
    bucket, n = cells[:, 0].astype(np.int64), cells[:, 3]
    likely = np.stack([np.where(cells[:, k] < 0, 0.0, np.exp(-cells[:, k] / GRID)) for k in (1, 2)] + [np.full(len(cells), 1 / (vocabulary + 1))], axis=1)
    for _ in range(rounds):
        joint = mix[bucket] * likely
        share = joint / joint.sum(axis=1, keepdims=True) * n[:, None]
        for k in range(3):
            # A tenth of a count keeps every weight above zero.
            mix[:, k] = np.bincount(bucket, weights=share[:, k], minlength=LEVELS) + 0.1 * np.array(DEFAULT)[k]
        mix[0, 0] = 0
        mix /= mix.sum(axis=1, keepdims=True)
    return mix


def scorer(blocks: int, mix: np.ndarray, vocabulary: int, total: int):
    """Step 4, per block: token counts and both log probabilities of every text."""
    names = ["doc_id", "role", "n_tokens", "n_known", "base_score", "score"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(key, table, replies):
        if not table.num_rows:
            return pa.table([pa.array([], kind) for kind in kinds], names=names)
        tokens = Tokens(table.column("text").to_pylist())
        asked = Asked(tokens, blocks)
        answers = replies_of(replies)
        word, pair = asked.filled(answers, True), asked.filled(answers, False)
        c, context = word[asked.word_at], word[asked.context_at]
        base = np.log10((c + 0.5) / (total + 0.5 * (vocabulary + 1)))
        own = mix[level(context)]
        score = np.log10(own[:, 0] * ratio(pair[asked.pair_at], context) + own[:, 1] * ratio(c, total) + own[:, 2] / (vocabulary + 1))
        ids = [None if i == NULL_ID else i for i in table.column("doc_id").to_pylist()]
        sums = [np.add.reduceat(x, tokens.first) for x in ((c > 0).astype(np.int64), base, score)]
        return pa.table([pa.array(x, kind) for x, kind in zip([ids, table.column("role").to_pylist(), tokens.lengths, *sums], kinds, strict=True)], names=names)
    return run


def score(docs: DataFrame, training: Column, deleted: Column, id_col: str = "doc_id", text_col: str = "text",
          block_bytes: int = exchange.BLOCK_BYTES) -> DataFrame:
    """``(doc_id, trained, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``docs``.

    ``training`` says which rows the model learns from, ``deleted`` which of these are left out while the weights are learned; both
    may use the columns of ``docs``. Tokens are words between ASCII white space with A-Z lowered, then one end per text. ``n_known``
    counts tokens seen in training; ``base_score`` is the unigram score with half a count added, ``score`` that of the model; both
    are log10 probabilities of the whole text. Repeated rows count as often as they stand there. Null and empty texts have the end
    only. Without training rows nothing is known and all texts of one length score alike.
    """
    role = F.when(F.coalesce(training, F.lit(False)), F.when(F.coalesce(deleted, F.lit(False)), DELETED).otherwise(TRAINING)).otherwise(UNSEEN)
    texts, blocks = exchange.blocked(docs.select(id_col, text_col, role.cast("int").alias("role")), block_bytes, id_col, text_col, ["role"])
    asked = texts.groupBy("block").applyInArrow(questions(blocks), exchange.schema(SENT))
    answers = stored(asked.groupBy("bucket").applyInArrow(totals(blocks), ANSWER), "ngram-totals")
    size = answers.agg(F.sum("vocabulary").alias("v"), F.sum("total").alias("n")).first()
    vocabulary, total = size.v or 0, size.n or 0
    held = texts.where(F.col("role") == DELETED)
    words = F.split(F.trim(F.regexp_replace("text", "[\\x20\\x09-\\x0D]+", " ")), " ")
    deleted_total = held.agg(F.sum(F.size(F.filter(words, lambda w: w != "")) + 1)).first()[0] or 0
    pairs = held.groupBy("block").cogroup(answers.where(F.col("block") >= blocks).withColumn("block", F.col("block") - blocks).groupBy("block"))
    cells = pairs.applyInArrow(evidence(blocks, total, deleted_total), "level long, pair long, word long, n long").groupBy(
        "level", "pair", "word").agg(F.sum("n").alias("n"))
    mix = weights(np.array([tuple(row) for row in cells.collect()], dtype=np.float64), vocabulary)
    rows = texts.groupBy("block").cogroup(answers.where(F.col("block") < blocks).select("block", "bucket", "words", "pairs").groupBy("block"))
    scored = rows.applyInArrow(scorer(blocks, mix, vocabulary, total), "doc_id long, role int, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", (F.col("role") != UNSEEN).alias("trained"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
                         "base_score", "score")
