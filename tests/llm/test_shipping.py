import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
import public_tokenizers
from tests.session import local_session
from wordtide.llm import attention, bpe, licenses, neardup, substrings, suffixes
spark = local_session(2)
docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id BIGINT, text STRING")
labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id BIGINT, quality INT")
for found in (
    substrings.substring_dedup(docs), suffixes.suffix_dedup(docs), neardup.near_duplicates(docs),
    attention.quality_scores(docs, labels), licenses.license_matches(docs),
    bpe.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json")),
):
    assert found.count() == 2
print("done")
"""


def test_tasks_need_no_installed_package(tmp_path):
    """Python workers that cannot import the package run its functions."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert ran.stdout.strip().endswith("done"), ran.stderr[-3000:]
