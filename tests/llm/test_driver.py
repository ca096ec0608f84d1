import ast
import pathlib
from collections import Counter

ROOT = pathlib.Path(__file__).parents[2] / "muster" / "llm"
GATHERS = {"collect", "toArrow", "toPandas", "toLocalIterator", "crossJoin", "localCheckpoint"}
# All bounded: lengths of pieces; buckets; anchors and positives of one block; centroids' sample and vector widths; numbers of tasks; histograms
# and queries of one block; classes, terms and vectors of the labelled sample.
ALLOWED = {
    ("best_fit.py", "collect"): 1, ("importance.py", "collect"): 1,
    ("hard_negatives.py", "collect"): 1, ("hard_negatives.py", "toArrow"): 1,
    ("neardup_vectors.py", "collect"): 1, ("neardup_vectors.py", "toArrow"): 1,
    ("topk.py", "collect"): 1, ("topk.py", "toArrow"): 1,
    ("toxicity.py", "collect"): 3,
}


def test_only_bounded_frames_reach_the_driver():
    calls = Counter(
        (path.name, node.func.attr)
        for path in ROOT.rglob("*.py")
        for node in ast.walk(ast.parse(path.read_text()))
        if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and node.func.attr in GATHERS
    )
    assert calls == ALLOWED
