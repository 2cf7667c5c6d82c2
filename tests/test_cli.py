import json

import pytest

from millrace.__main__ import main
from millrace.scratch import scratch_path

DOCUMENT = {
    "A": {
        "link": "/a",
        "restaurants": {
            "1": {"name": "x", "menu": {"M": {"Pie": {"price": 5}}}},
            "2": {"name": "y"},
        },
    }
}


def test_jobs_chain_from_documents_to_a_stamped_copy(spark, tmp_path, capsys):
    (tmp_path / "doc.json").write_text(json.dumps(DOCUMENT))
    base = scratch_path(spark, "test-cli")
    main(["flatten", str(tmp_path), "--entities", f"{base}/e", "--items", f"{base}/i",
          "--rejects", f"{base}/r"])
    assert "'entities': 2, 'items': 1, 'rejected': 0" in capsys.readouterr().out
    main(["profile", f"{base}/e", "--output", f"{base}/profile"])
    assert spark.read.parquet(f"{base}/profile").where("is_valid").count() >= 1
    main(["split", f"{base}/e", "--output", f"{base}/shards"])
    main(["clean", f"{base}/shards", "--output", f"{base}/clean", "--rejects", f"{base}/bad",
          "--set", "source=local", "environment=test", "--run-id", "1"])
    clean = spark.read.parquet(f"{base}/clean")
    assert {(r["id"], r["city"], r["source"]) for r in clean.collect()} == {
        ("1", "A", "local"), ("2", "A", "local"),
    }
    main(["stream", f"{base}/clean", "--output", f"{base}/out", "--checkpoint", f"{base}/c",
          "--schema", "id string, salt string", "--every", "once"])
    assert spark.read.parquet(f"{base}/out").where("read_timestamp is not null").count() == 2


def test_missing_arguments_stop_at_once():
    with pytest.raises(SystemExit):
        main(["clean", "somewhere"])
