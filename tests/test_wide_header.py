"""A header wider than the columns looked at first, in a file whose name holds pattern characters."""

import os

import pytest

from reelhouse.sources import bronze


@pytest.mark.parametrize("width", [499, 500, 501, 620])
def test_wide_export_with_a_pattern_name_loads_whole(spark, tmp_dir, width):
    names = [f"c{i}" for i in range(width)]
    for name in ("plain.csv", "wide[1].csv"):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(",".join(names) + "\n" + ",".join(str(i) for i in range(width)) + "\n")
    plain, odd = (bronze.read_export(spark, os.path.join(tmp_dir, name)) for name in ("plain.csv", "wide[1].csv"))
    assert odd.columns == plain.columns == names
    assert odd.first() == plain.first()
