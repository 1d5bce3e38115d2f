"""What the join on keys carries."""

from eventide.llm import jaccard_join as jj
from eventide.llm.common import written


def test_members_of_keys_carry_no_sketches(spark, monkeypatch):
    """Only pairs, and members of keys with several components, do."""
    made = {}

    def noted(df, name, *args, **kw):
        made[name] = out = written(df, name, *args, **kw)
        return out

    monkeypatch.setattr(jj, "written", noted)
    text = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(text[:i] + ["new"] + text[i + 1:])) for i in range(40)]
    out = jj.groups(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80, 100)
    assert {r["component_id"] for r in out.collect()} == {0}
    assert "jaccard-members" not in made
    assert made["jaccard-keys"].columns == ["key", "d0"] and made["jaccard-star"].columns == ["d0", "p0"]
    assert made["jaccard-placed"].count() == 0
