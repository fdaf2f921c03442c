import json

import pytest

from quillspark.__main__ import main, parser
from quillspark.operators import generation as g


REQUEST = g.GenerationRequest(topic="gardens", objective="teach", audience="beginners", desired_duration_seconds=20.0, desired_cta="act now")


def test_query_and_outline():
    q = g.build_query(REQUEST)
    assert (q.text, q.max_duration_seconds, q.candidate_limit) == ("gardens teach beginners", 35.0, 500)
    assert g.build_query(REQUEST, 40).candidate_limit == 1000
    for seconds in (4.0, 20.0, 90.0):
        r = g.GenerationRequest(topic="t", objective="o", audience="a", desired_duration_seconds=seconds)
        sections = g.outline(r, [])["sections"]
        assert [s["role"] for s in sections] == ["hook", "setup", "body", "cta"] and sections[-1]["end_seconds"] == seconds
        assert all(a["end_seconds"] == b["start_seconds"] for a, b in zip(sections, sections[1:]))
        assert [s["end_seconds"] for s in sections] == [min(3.0, seconds), seconds * 0.25, seconds * 0.85, seconds]
    hits = [{"record_id": "r1", "source_content_hash": "h1", "score": 0.5, "hooks": ["question"], "devices": ["contrast", "list"]}]
    result = g.outline(REQUEST, hits)
    assert result["creative_mechanisms"] == ["contrast", "list", "question"] and result["retrieved_evidence"][0]["relevance_score"] == 0.5
    assert result["rationale"][0]["evidence_record_ids"] == ["r1"] and result["contract_version"] == "1.0.0"
    assert result["delivery_notes"] and result["on_screen_text_suggestions"] == [{"at_seconds": 0.0, "text": "gardens"}]


def test_draft_refuses(spark):
    empty = spark.createDataFrame([], "record_id string, source_content_hash string, text string, duration_seconds double, hooks array<string>, devices array<string>, fingerprint array<string>, vector array<double>")
    assert g.draft(empty, REQUEST)["cta"] == "act now"
    with pytest.raises(ValueError, match="banned"):
        g.draft(empty, g.GenerationRequest(**{**REQUEST.__dict__, "banned_patterns": ("ACT now",)}))
    with pytest.raises(ValueError, match="topic"):
        g.draft(empty, g.GenerationRequest(**{**REQUEST.__dict__, "topic": ""}))


def test_command_line(capsys):
    assert main(["estimate", "--records", "7500", "--average-words", "100"]) == 0
    assert json.loads(capsys.readouterr().out)["requests"] == 22500
    with pytest.raises(SystemExit):
        parser().parse_args(["unknown"])
