"""A worker of op10 keeps no freed memory, and its batches are bounded by bytes."""
import subprocess
import sys

import public_tokenizers

from hrlens.llm import dac

KEPT = """
import re, sys
import pyarrow as pa
from hrlens.llm import dac
def own():
    return sum(map(int, re.findall(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) // 1024
w = dac.WordEncoder(sys.argv[1])
w.encode([" ".join(f"w{i % 5000} x{i // 7}" for i in range(k, k + 400)) for k in range(0, 400_000, 400)])
used = own()
pa.default_memory_pool().release_unused()
print(used - own())
"""


def test_arrow_memory_is_given_back():
    out = subprocess.run([sys.executable, "-c", KEPT, public_tokenizers.path("byte_bpe_50k.json")], capture_output=True, text=True, check=True)
    assert int(out.stdout) < 15  # MB; 28 when the pool kept it


def test_batches_are_bounded_by_bytes(spark, tmp_path):
    docs = spark.range(1500).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 2000) AS text").coalesce(1)
    dac.write_token_files(docs.where("doc_id < 3"), public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "ids"))

    def sizes(batches):
        for b in batches:
            yield b.assign(size=b["text"].str.len().sum(), rows=len(b))[["size", "rows"]][:1]
    found = docs.mapInPandas(sizes, "size long, rows long").collect()
    assert sum(r["rows"] for r in found) == 1500
    assert max(r["size"] for r in found) < 1.5 * (4 << 20)  # 24 MB in all; was one batch
    assert dac.read_tokens(spark, str(tmp_path / "ids")).count() == 3
