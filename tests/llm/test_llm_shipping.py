"""Operators run where workers cannot import the package from the driver's folder."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from worklink.session import local_session, ship
spark = local_session(2, 2)
ship(spark)
from worklink.llm import bpe, divergence, exact, fingerprints, jaccard, language, packing, quality, queries, runs, token_counts
docs = spark.createDataFrame([(i, "some words here " * (i + 1), "en", "s" + str(i % 2)) for i in range(12)],
                             "doc_id long, text string, lang string, source string")
labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
path = queries.vocabulary
assert token_counts.token_counts(docs, path("piece_bpe_32k.model")).count() == 12
assert bpe.bpe_roundtrip(docs, path("byte_bpe_50k.json")).count() == 12
assert packing.pack(docs, path("word_bpe_49k.json")).count() == 12
assert language.identify_languages(docs).count() == 12
language.keep_known_languages(docs).count()
assert quality.classify_quality(docs, labels).count() == 12
assert jaccard.jaccard_components(docs).count() == 12
assert fingerprints.document_fingerprints(docs).count() == 12
assert runs.periodic_runs(docs).count() == 12 and exact.exact_duplicates(docs).count() == 12
divergence.source_divergence(docs, min_docs=2).count()
print("all ran")
"""


def test_operators_from_another_folder(tmp_path):
    repo = str(Path(__file__).resolve().parents[2])
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo)], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-1500:]
