"""Records of delimited files against a parser that reads a file as a whole."""

import csv
import io
import random

import pytest

from screenmeld.sources import listing
from screenmeld.sources import records as R
from screenmeld.sources import tables as T


def rows_of(spark, files, cut):
    """Lines as they come from splits of ``cut`` lines each."""
    out = []
    for name, text in files.items():
        for k, line in enumerate(text.split("\n")):
            out.append((name, 1000 * (k // cut), (k // cut << 33) + k % cut, line))
    random.Random(0).shuffle(out)
    return spark.createDataFrame(out, "path string, block long, seq long, value string")


def quoted(rng, sep):
    text = rng.choice(["a", "b\nc", "x\n\n\ny", f"p{sep}q", 'say "so"', "\n", "", "é", f'"\n{sep}"', "plain"])
    return '"' + text.replace('"', '""') + '"' if rng.random() < 0.5 or set(text) & {"\n", '"', sep} else text, text


@pytest.mark.parametrize("cut, bits", [(1, 17), (3, 1), (10_000, 17), (10_000, 2)])
def test_quoted_line_breaks_over_splits(spark, cut, bits, monkeypatch):
    monkeypatch.setattr(R, "PIECE_BITS", bits)
    rng, files, want = random.Random(cut + bits), {}, []
    for n, sep in enumerate(",;\t|"):
        lines = [sep.join(["Rank", "Ligand", "ECR_Score"])]
        for k in range(60):
            cells = [quoted(rng, sep) for _ in range(2)]
            lines.append(sep.join([str(k), *(c[0] for c in cells)]))
            want.append((str(k), *(c[1] or None for c in cells)))
        files[f"f{n}"] = "\n".join(lines)
        again = list(csv.reader(io.StringIO(files[f"f{n}"]), delimiter=sep))[1:]
        assert [tuple(x or None for x in r) for r in again] == want[-60:]
    df, known = T.sniffed_lines(rows_of(spark, files, cut))
    assert df.columns == ["Rank", "Ligand", "ECR_Score"] and known["ecr"] == "ECR_Score"
    key = lambda r: tuple(x or "" for x in r)
    assert sorted((tuple(x or None for x in r) for r in df.collect()), key=key) == sorted(want, key=key)


def test_too_many_layouts(spark, monkeypatch):
    monkeypatch.setattr(T, "MOST_LAYOUTS", 2)
    with pytest.raises(ValueError):
        T.sniffed_lines(rows_of(spark, {f"f{k}": f"a{k},b\n1,2" for k in range(3)}, 5))


def test_listing_by_tasks(spark, tmp_path):
    for name in ("t1/a.x", "t1/deep/er/b.x", "t 2%20/é+.x", "c.x", ".hidden.x", "_tmp/d.x", "k=1/e.x", "t1/no.y"):
        file = tmp_path / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("" if "b.x" in name else "text")
    root = f"file:{tmp_path}"
    got = lambda **o: sorted((r.path.removeprefix(f"{root}/"), r.length) for r in listing.list_files(spark, str(tmp_path), "*.x", **o).collect())
    every = [("c.x", 4), ("k=1/e.x", 4), ("t 2%20/é+.x", 4), ("t1/a.x", 4), ("t1/deep/er/b.x", 0)]
    assert got() == every and got(recursive=False) == every[:2]
    index = listing.indexed_files(spark, str(tmp_path), True).collect()
    assert {(r.path.removeprefix(f"{root}/"), r.length) for r in index if r.path.endswith(".x")} == set(every)
    with pytest.raises(FileNotFoundError):
        listing.list_files(spark, str(tmp_path / "none"))
    assert not listing.reachable("viewfs://store/in")
