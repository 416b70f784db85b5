"""Words, hashes and odd tables for the tests, written without the library."""

import re
import zlib

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NONSPACE = re.compile(r"[^\x20\x09-\x0D]+")

SMALL = "/root/testdata/sf0.001"

ODD_TEXTS = [
    "", None, "a  b", "a \n b\n\nc", "x  y  z\t\tq ", "<|endoftext|> a <|endoftext|>  b", "don't I'll  'tis 's",
    "  lead", "trail  ", "é è　ü 12345 !!?? 日本 語", "\n\n", "A<|x", "    b", "\x1c a\x1db", "ÀÉÎ Straße ÷ ×",
    "one", "🙂 ok", "a b", "|", "0", " ", "word " * 3_000,
]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text, pattern=ALNUM):
    return pattern.findall(lower(text))


def crc(data):
    return zlib.crc32(data.encode() if isinstance(data, str) else data)


def documents(spark, folder=SMALL):
    return spark.read.parquet(f"{folder}/documents.parquet")


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
