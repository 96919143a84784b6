from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from endmark.__main__ import main

from .test_plans import SAM


def test_commands(spark, tmp_path, capsys):
    (tmp_path / "x.sam").write_text(SAM)
    main(["scan", "--records", f"{tmp_path}/x.sam", "--sample", "S", "--out", f"{tmp_path}/e", "--exclude", "chrM"])
    assert "kept\t3" in capsys.readouterr().out and spark.read.parquet(f"{tmp_path}/e").count() == 3
    (tmp_path / "s.tsv").write_text("sample_id\tcondition\tcontrol\n" + "".join(f"S{k}\t{'T' if k > 3 else 'C'}\t{'C' if k > 3 else ''}\n" for k in range(8)))
    main(["validate", "--samples", f"{tmp_path}/s.tsv"])
    (tmp_path / "bad.tsv").write_text("sample_id\tcondition\tcontrol\na\tT\tX\n")
    with pytest.raises(SystemExit):
        main(["validate", "--samples", f"{tmp_path}/bad.tsv"])
    rng = np.random.default_rng(1)
    rows = [(f"S{s}", "c", "+", g * 5000 + at, "read_3p", int(rng.poisson(60 if (at == 0) == (s < 4 or g % 2) else 200))) for g in range(6) for s in range(8) for at in (0, 1000)]
    spark.createDataFrame(rows, "sample_id string, contig string, strand string, coordinate long, evidence_source string, count long").write.parquet(f"{tmp_path}/ev")
    main(["cluster", "--evidence", f"{tmp_path}/ev", "--out", f"{tmp_path}/c"])
    spark.read.parquet(f"{tmp_path}/c").withColumn("gene_id", F.concat(F.lit("g"), F.expr("coordinate div 5000"))).write.parquet(f"{tmp_path}/atlas")
    main(["analyse", "--evidence", f"{tmp_path}/ev", "--atlas", f"{tmp_path}/atlas", "--samples", f"{tmp_path}/s.tsv", "--control", "C", "--out", f"{tmp_path}/o", "--report", f"{tmp_path}/r.html"])
    events = spark.read.parquet(f"{tmp_path}/o/sites").filter("event_type <> 'none'").select("gene_id").distinct().collect()
    assert {r.gene_id for r in events} == {"g0", "g2", "g4"} and "event_type" in (tmp_path / "r.html").read_text()
