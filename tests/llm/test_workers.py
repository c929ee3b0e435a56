"""Every operator's query in a session whose workers cannot import the package."""

import json
import os
import subprocess
import sys
import textwrap

from ampere.llm.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = textwrap.dedent("""
    import json, sys
    from pyspark.sql import SparkSession
    root, table_dir, names = sys.argv[1], sys.argv[2], sys.argv[3].split(",")
    spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")

    def seen(_):
        try:
            import ampere
            return ["importable"]
        except ImportError:
            return ["absent"]

    sys.path.insert(0, root)  # the driver alone finds the package
    import __spark_entry__ as entry
    out = {"workers": spark.sparkContext.parallelize([0], 1).mapPartitions(seen).first()}
    for name in names:
        df = entry.queries()[name](spark, table_dir)
        out[name] = len(df.collect())
    print("RESULT " + json.dumps(out))
""")


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env["PYTHONPATH"] = os.pathsep.join(p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep)
                                        if p and os.path.abspath(p) != ROOT)
    script = tmp_path / "run.py"
    script.write_text(SCRIPT)
    done = subprocess.run([sys.executable, str(script), ROOT, "/root/testdata/sf0.001", ",".join(sorted(QUERIES))],
                          cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1500)
    line = [x for x in done.stdout.splitlines() if x.startswith("RESULT ")]
    assert line, done.stderr[-3000:]
    out = json.loads(line[0][7:])
    assert out.pop("workers") == "absent"
    assert set(out) == set(QUERIES) and all(n > 0 for n in out.values())
