"""Language identification by segmentation-marginalised unigrams.

Each learned language has a probability for every piece of a fixed public vocabulary.  A word (with its
leading word mark) is generated by drawing pieces independently; its probability sums over all its
segmentations into pieces, which the forward algorithm gives.  A text's likelihood is the product over
its words, for no piece reaches over white space.  The score is the posterior of the best language.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hushwire.llm.common import map_arrow, share, table, text_fold

HOLD_OUT = 3
#: Bound, in expectation, of the documents that piece counts are learned from.
SAMPLE = 12_000
MARK = "▁"
#: Longest piece of the vocabulary, and characters after which sums are brought back to scale.
LONGEST, RESCALE = 16, 8
#: Characters of the words that are scored at once.
AT_ONCE = 480_000
#: Words whose likelihoods a task keeps.
KEPT = 300_000
SMOOTHING = 0.05


def vocabulary(path: str) -> list[str]:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]


class Trie:
    """What pieces begin with, as numbered nodes; whole arrays of nodes take a step at once, by a table of
    node and character with linear probing."""

    MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: list[str]):
        steps: dict[int, int] = {}
        ends = []
        for p in pieces:
            node = 0
            for c in p:
                node = steps.setdefault(node << 21 | ord(c), len(steps) + 1)
            ends.append(node)
        #: Node -> number of the piece that ends there, or -1.
        self.piece = np.full(len(steps) + 1, -1, np.int64)
        self.piece[ends] = np.arange(len(pieces))
        bits = max(4, (4 * len(steps)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.to = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        slots = self.slots(np.fromiter(steps, np.int64, len(steps))).tolist()
        for (key, node), slot in zip(steps.items(), slots, strict=True):
            while self.keys[slot] >= 0:
                slot = slot + 1 & self.last
            self.keys[slot], self.to[slot] = key, node

    def slots(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * self.MULTIPLIER >> self.shift).view(np.int64)

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The nodes after one more character, -1 where no piece goes on so."""
        key = node << 21 | char
        slot = self.slots(key)
        seen, to = self.keys[slot], self.to[slot]
        other = seen != key
        to[other] = -1
        look = np.flatnonzero(other & (seen >= 0))
        while len(look):
            slot[look] = slot[look] + 1 & self.last
            seen = self.keys[slot[look]]
            right = seen == key[look]
            to[look[right]] = self.to[slot[look[right]]]
            look = look[~right & (seen >= 0)]
        return to


class Forward:
    """Words to log likelihoods by language."""

    def __init__(self, pieces: list[str], probs: np.ndarray):
        """probs: pieces x languages; its last row is for a character that no piece has."""
        used = [i for i, p in enumerate(pieces) if len(p) <= LONGEST]
        self.trie = Trie([pieces[i] for i in used])
        self.probs = np.vstack([probs[used], probs[len(pieces) :]])

    def words(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.probs.shape[1]))
        by: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by.setdefault(len(w) + 1, []).append(k)
        for n, found in by.items():
            step = max(1, AT_ONCE // n)
            for a in range(0, len(found), step):
                part = found[a : a + step]
                out[part] = self._same_length([MARK + words[k] for k in part], n)
        return out

    def _same_length(self, words: list[str], n: int) -> np.ndarray:
        """The forward sums of words of n characters.  Only the last LONGEST sums are held."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), n)
        trie, probs, every = self.trie, self.probs, np.arange(len(words))
        held = [np.ones((len(words), probs.shape[1]))]
        scale = np.zeros_like(held[0])
        # what pieces may go on: their words, where they start and their nodes, in order of starts
        row, start, node = (np.zeros(0, np.int64) for _ in range(3))
        for i in range(1, n + 1):
            low = max(0, i - LONGEST)
            row, start, node = np.concatenate([row, every]), np.append(start, np.full(len(words), i - 1)), np.append(node, np.zeros(len(words), np.int64))
            node = trie.step(node, codes[:, i - 1].astype(np.int64)[row])
            on = np.flatnonzero(node >= 0)
            row, start, node = row[on], start[on], node[on]
            piece = trie.piece[node]
            whole = np.flatnonzero(piece >= 0)
            at, piece = row[whole], piece[whole]
            edges = np.searchsorted(start[whole], np.arange(low, i + 1))
            one = np.full(len(words), -1)  # a character that is no piece has the last row of all
            one[at[edges[-2] :]] = piece[edges[-2] :]
            total = held[-1] * probs[one]
            for k in range(i - low - 1):
                some = slice(edges[k], edges[k + 1])
                hit = at[some]
                if len(hit):
                    total[hit] += held[k][hit] * probs[piece[some]]
            held = [*held[-(LONGEST - 1) :], total]
            if i % RESCALE == 0:
                top = np.maximum(total, 1e-300)
                held = [h / top for h in held]
                scale += np.log(top)
        return np.log(np.maximum(held[-1], 1e-300)) + scale


def learn(docs: DataFrame, vocab_path: str, sample: int = SAMPLE):
    """(languages, pieces, probabilities, priors) from a bounded sample of the learning folds: counts of
    the vocabulary's own segmentation, smoothed.  None where nothing is labelled."""
    known = docs.where(F.col("lang").isNotNull() & (text_fold("doc_id", HOLD_OUT) != 1)).select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return None
    langs = sorted(sizes)
    rate = F.lit(0.0)
    for lang in langs:  # every language gets an equal part of the sample
        rate = F.when(F.col("lang") == lang, F.lit(min(1.0, sample / len(langs) / sizes[lang]))).otherwise(rate)
    scale = 1 << 30
    picked = known.where(F.pmod(F.xxhash64("doc_id", F.lit(21)), F.lit(scale)) < rate * scale).select("lang", "text")

    def make():
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=vocab_path)

        def run(c):
            seen: dict[str, Counter] = {}
            for lang, text in zip(c["lang"].to_pylist(), c["text"].to_pylist(), strict=True):
                seen.setdefault(lang, Counter()).update(sp.encode(text or "", out_type=str, num_threads=1))
            rows = [(lang, p, n) for lang, count in seen.items() for p, n in count.items()]
            return {k: [r[i] for r in rows] for i, k in enumerate(("lang", "piece", "n"))}

        return run

    counts = map_arrow(picked, make, "lang string, piece string, n long", "text").groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()
    pieces = vocabulary(vocab_path)
    at = {p: i for i, p in enumerate(pieces)}
    table_ = np.full((len(pieces) + 1, len(langs)), SMOOTHING)
    for r in counts:
        table_[at.get(r["piece"], len(pieces)), langs.index(r["lang"])] += r["n"]
    table_ /= table_.sum(0)
    total = sum(sizes.values())
    return langs, pieces, table_, np.log([sizes[x] / total for x in langs])


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def identify(docs: DataFrame, model, keep_words: int = KEPT) -> DataFrame:
    """Best language and its posterior for every row, from the text alone.  A null text or one without a
    letter, and any text where nothing was learned, is `und` with score 0; of languages that tie the
    first by name is taken.  Repeated rows are each scored; an empty table gives an empty result; extra
    columns are ignored.  Words of any length are summed over all their segmentations."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (text_fold("doc_id", HOLD_OUT) == 1).alias("held_out"), "text")

    shared = docs.sparkSession.sparkContext.broadcast(Forward(*model[1:3])) if model else None
    langs, prior = (model[0], model[3]) if model else ([], np.zeros(0))

    def make():
        forward = shared.value if shared else None
        index: dict[str, int] = {}
        logs = [np.zeros((0, len(langs)))]

        def run(c):
            texts = c["text"].to_pylist()
            split = [t.split() if t else [] for t in texts]
            out_lang, out_score = ["und"] * len(texts), np.zeros(len(texts))
            if forward:
                new = list({w for ws in split for w in ws}.difference(index))
                first = len(logs[0])
                both = np.concatenate([logs[0], forward.words(new)])
                index.update(zip(new, range(first, first + len(new)), strict=True))
                for k, ws in enumerate(split):
                    if ws and any(map(str.isalpha, texts[k])):
                        total = both[np.fromiter(map(index.__getitem__, ws), np.int64, len(ws))].sum(0) + prior
                        post = np.exp(total - total.max())
                        out_lang[k] = langs[int(total.argmax())]
                        out_score[k] = post.max() / post.sum()
                if len(both) <= keep_words:
                    logs[0] = both
                else:
                    for w in new:
                        del index[w]
            return {"doc_id": c["doc_id"], "held_out": c["held_out"], "lang_pred": out_lang, "score": out_score}

        return run

    return map_arrow(rows, make, SCHEMA, "text")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents; see identify for nulls, ties, repeats and empty tables."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, learn(docs, path))
