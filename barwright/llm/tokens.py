"""Token counts of whole texts, by a two-tier table of pre-token lengths.

A text is cut at spaces and line ends, which the tokenizer drops; its count is the sum of the
lengths of the pieces, which do not depend on their neighbours. Lengths of frequent pieces come
from a table that Spark sends to every task; others are encoded by the library and remembered
by the worker. No piece is shuffled.

The table is chosen from a sample of at most `SAMPLE_ROWS` texts and has at most `FREQUENT`
entries. It decides only where a length is looked up, never the result. Texts that hold the
string of a special token go to the library whole, which treats it as its default says.

A null or empty text has no tokens. Repeated rows and ids are kept; other columns are ignored.
"""

from __future__ import annotations

import json
import os
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, texts

SAMPLE_ROWS = 2_000
FREQUENT = 20_000
#: Lengths that a worker remembers besides; forgotten all at once beyond that.
REMEMBERED = 300_000
LIMIT = 2_048


class TokenCounter:
    """Counts tokens of texts as the library does for the tokenizer file."""

    def __init__(self, path: str, frequent: dict[str, int] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if not _apart(spec):
            raise ValueError("pre-tokens of this tokenizer depend on the spaces around them")
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.frequent = frequent or {}
        self.met: dict[str, int] = {}

    def lengths(self, pieces: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(pieces, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        frequent, met, out = self.frequent, self.met, []
        for text in texts:
            if any(special in text for special in self.special):
                out.append(self.lengths([text])[0])
                continue
            pieces = pieces_of(text)
            found = list(map(frequent.get, pieces))
            if None in found:
                missing = [at for at, n in enumerate(found) if n is None]
                wanted = {pieces[at] for at in missing}
                new = [piece for piece in wanted if piece not in met]
                if len(met) + len(new) > REMEMBERED:
                    met.clear()
                    new = list(wanted)
                met.update(zip(new, self.lengths(new)))
                for at in missing:
                    found[at] = met[pieces[at]]
            out.append(sum(found))
        return out


def _apart(spec: dict) -> bool:
    """Whether white space is dropped and nothing of a word depends on what stands beyond it."""
    steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
    split = [s for s in steps if s["type"] == "Split"]
    return (len(split) == 1 and split[0]["invert"] and split[0]["behavior"] == "Removed"
            and all(not s.get("add_prefix_space") for s in steps)
            and not any(t["normalized"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]))


def pieces_of(text: str) -> list[str]:
    """Pre-tokens with what clings to them: what stands between spaces and line ends."""
    return text.replace("\n", " ").split(" ")


def frequent_lengths(docs: DataFrame, path: str) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of a bounded sample; runs one job."""

    def counted(batches):
        counter, seen = TokenCounter(path), Counter()
        for pdf in batches:
            for text in pdf["text"]:
                seen.update(pieces_of(text))
        top = [piece for piece, _ in seen.most_common(FREQUENT)]
        yield pd.DataFrame({"piece": top, "length": counter.lengths(top)})

    sample = docs.select("text").limit(SAMPLE_ROWS).mapInPandas(counted, "piece string, length int")
    return {row["piece"]: row["length"] for row in sample.limit(FREQUENT).collect()}


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every text; runs one small job first."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = texts(docs, id, text)
    lengths = spark.sparkContext.broadcast(frequent_lengths(rows, path))

    def counted(batches):
        counter = TokenCounter(path, lengths.value)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_bytes": pdf["n_bytes"],
                                "n_tokens": counter.counts(list(pdf["text"]))})

    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    rows = rows.mapInPandas(counted, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
