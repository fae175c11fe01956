"""One registered query per operator, and the pipeline."""

import __spark_entry__ as entry
import corpus_pipeline


def test_thirteen_operators_and_the_pipeline_are_registered():
    names = list(entry.queries())
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id",
        "near_duplicates",
        "decontamination",
        "mixing",
        "token_store",
    ]
