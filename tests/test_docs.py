"""The README's Python example runs as written, on a capture landing built
from the testdata (its /data paths are pointed at that landing)."""

import os
import re

from conftest import ROOT, SF_SMALL
from reconlake.plans import stream_queries as sq


def test_readme_example_runs(spark):
    text = open(os.path.join(ROOT, "README.md")).read()
    code = re.search(r"```python\n(.*?)```", text, flags=re.S).group(1)
    land = sq.Landing(spark, SF_SMALL)
    code = code.replace("/data/cdr-events", land.cdr_dir).replace("/data/edr-events", land.edr_dir)
    scope = {"spark": spark}
    exec(compile(code, "README.md", "exec"), scope)
    assert scope["detail"].count() == 1003          # FIXTURES.md: detail rows at sf0.001
    assert scope["daily"].count() > 0
