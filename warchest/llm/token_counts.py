"""Token counts by a whole-token shortcut.

Offline, each vocabulary string that closes a word is encoded alone; those that give exactly one token are proven.
A pre-token that is proven counts one.  Only the others are merged, each once per task while the memory bound holds.

The rules of the pre-tokens are those of the word-end BPE file: special strings are cut out first and count one each;
then NFC, lower case, and a split that drops white space.  Texts that, in lower case, have a character from U+0250 on are normalised and
split by the tokenizer library itself, so that no other Unicode table decides.

Results: a missing or empty text has 0 bytes and 0 tokens.  Rows are independent: repeated rows and ids give repeated rows.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

from warchest.llm.common import map_texts

# The pre-token pattern of the file, its classes written out for characters below U+0250.
_L = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_N = "0-9²³¹¼-¾"
_S = "\t-\r \u0085 "
PRE_TOKEN = f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+"
WORD_END = "</w>"
#: Pre-tokens whose counts a task remembers at once.
REMEMBERED = 1_000_000


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary, by the usual rule: printable ones stand for themselves,
    the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def prove_whole(definition: str) -> list[str]:
    """Strings of the vocabulary that, as the library encodes them alone, are one token."""
    from tokenizers import Tokenizer

    tokenizer, letters = Tokenizer.from_str(definition), byte_letters()
    words = []
    for entry in json.loads(definition)["model"]["vocab"]:
        body = entry.removesuffix(WORD_END)
        if body == entry or not body or any(c not in letters for c in body):
            continue
        try:
            words.append(bytes(letters[c] for c in body).decode())
        except UnicodeDecodeError:  # part of a character
            continue
    found = tokenizer.encode_batch(words, add_special_tokens=False)
    pattern, specials = re.compile(PRE_TOKEN), set(special_strings(definition))
    return [
        w for w, e in zip(words, found, strict=True)
        if len(e.ids) == 1 and (pattern.fullmatch(w) or not w.isascii()) and w not in specials
    ]


def special_strings(definition: str) -> list[str]:
    return [x["content"] for x in json.loads(definition)["added_tokens"]]


def counter(definition: str, whole: list[str], remembered: int = REMEMBERED) -> Callable[[list], list[list]]:
    """A function from texts to their bytes and tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    specials = special_strings(definition)
    cut = re.compile("|".join(map(re.escape, specials))) if specials else None
    plain = re.compile(PRE_TOKEN).findall
    beyond = re.compile("[ɐ-\U0010ffff]").search
    cost = dict.fromkeys(whole, 1)
    least = len(cost)

    def split(piece: str) -> list[str]:
        low = piece.lower()  # some capitals below U+0250 have their small letter beyond it
        if low.isascii() or not beyond(low):
            return plain(low)
        ready = tokenizer.normalizer.normalize_str(piece)
        return [ready[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(ready)]

    def work(texts: list) -> list[list]:
        sizes, extra, parts, unknown = [], [], [], set()
        for text in texts:
            text = text or ""
            sizes.append(len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass")))
            if cut and "<|" in text:
                pieces = cut.split(text)
                extra.append(len(pieces) - 1)
                words = [w for piece in pieces for w in split(piece)]
            else:
                extra.append(0)
                words = split(text)
            parts.append(words)
            unknown.update(words)
        unknown.difference_update(cost)
        if len(cost) + len(unknown) > least + remembered:
            cost.clear()
            cost.update(dict.fromkeys(whole, 1))
            unknown = set().union(*parts).difference(cost)
        merge = list(unknown)
        for k in range(0, len(merge), 10_000):
            group = merge[k : k + 10_000]
            for w, e in zip(group, tokenizer.encode_batch_fast(group, add_special_tokens=False), strict=True):
                cost[w] = len(e.ids)
        known = cost.__getitem__
        return [sizes, [n + sum(map(known, words)) for n, words in zip(extra, parts, strict=True)]]

    return work


def count_tokens(
    df: DataFrame, tokenizer_file: str, *, text: str = "text", keep: list[str] = ("doc_id",),
    made: tuple[str, str] = ("n_bytes", "n_tokens"),
) -> DataFrame:
    """The columns `keep` with UTF-8 bytes and tokens of the text.  The file is read on the driver and sent along,
    a vocabulary of a few MB at most."""
    spark: SparkSession = df.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = f.read()
    sent = spark.sparkContext.broadcast((definition, prove_whole(definition)))
    fields = [T.StructField(name, T.LongType(), False) for name in made]
    return map_texts(df, text, list(keep), fields, lambda: counter(*sent.value))
