"""Write PLANS.md: the physical plans of representative statements (dev tool, not a test).

    python tests/explain_plans.py /root/testdata/sf0.1 > PLANS.md

What each statement stages (the rows it numbers, or writes) is captured while the migration
runs, then explained with ``explain('formatted')``; the operator tree, the columns that go
through range exchanges and the scan lines (pushed filters, read schema) are kept.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# (flow, label of what it stages) -> title
SHOW = {
    ("F16", "yaf_User-keys"): "users: portal users x accounts x profiles (+ zone property), anti join on (BoardID, Name)",
    ("F19", "yaf_UserGroup"): "registered membership: board users x flag-4 groups through the constant BoardID (J8)",
    ("F21", "yaf_UserGroup"): "role memberships: UserRoles x (roles x groups), then user_map",
    ("F28", "yaf_Topic-keys"): "topics: those without a reply are split off before the last author is looked up",
    ("F29", "yaf_Message-keys"): "first posts: narrow rows are numbered; Body is attached afterwards",
    ("F30", "yaf_Message-keys"): "replies: old messages pruned by lineage; narrow rows are numbered",
    ("F31", "yaf_Attachment-keys"): "attachments: a hash stands for the bytes until the rows are numbered",
    ("F31", "yaf_Attachment"): "attachments: the bytes attached; one exchange finds the distinct files and serves the join",
    ("F32", "topic_stats"): "topic statistics: messages reduced to open topics below the aggregate",
    ("F33", "yaf_WatchForum-keys"): "forum subscriptions: visit log pre-aggregated before the id mapping",
    ("F36", "forum_rollup"): "forum roll-up: only topics and messages with lineage",
}


def main(sf_dir: str) -> None:
    from forumshift.plans.migration import Migration
    from forumshift.plans.report import rejected_rows
    from forumshift.session import local_test_session
    from forumshift.sources import fixture_params, fixture_sources, fixture_targets

    spark = local_test_session(checkpoint=tempfile.mkdtemp(prefix="plans-"))
    captured = {}
    m = Migration(spark, fixture_sources(spark, sf_dir), fixture_targets(spark, sf_dir), fixture_params())
    store = m._store

    def spy(df, label):
        captured.setdefault((m._ctx.current, label), df)
        return store(df, label)

    m._store = spy
    m.run()
    jvm = spark.sparkContext._jvm
    print(f"# Physical plans of representative statements ({os.path.basename(sf_dir)}, local[8])\n")
    print("Generated by `tests/explain_plans.py`. Each block is the plan of the rows a statement numbers "
          "(or writes, where it numbers none), as Spark plans it before AQE re-optimises at runtime. "
          "Range exchanges list their columns; scans list their pushed filters and read schema.\n")
    captured["report", "replies"] = rejected_rows(m)["replies"]
    shown = SHOW | {("report", "replies"): "reject reasons of replies: marked left joins; rows without a key take lanes"}
    for (fid, label), title in shown.items():
        text = jvm.PythonSQLUtils.explainString(captured[fid, label]._jdf.queryExecution(), "formatted")
        tree, rest = text.split("\n\n", 1)
        scans = re.findall(r"\(\d+\) Scan parquet[^\n]*\nOutput[^\n]*\n(?:[^\n]+\n)*?ReadSchema: [^\n]*", rest)
        print(f"## {fid} {label} — {title}\n\n```\n{tree.strip()}\n```\n")
        ranged = re.findall(r"Exchange\nInput \[\d+\]: ([^\n]*)\nArguments: rangepartitioning", rest)
        for columns in ranged:
            print("Range exchange carries: `" + re.sub(r"#\d+L?", "", columns) + "`\n")
        pushed = [ln for s in scans for ln in s.splitlines() if ln.startswith(("PushedFilters", "ReadSchema"))]
        if pushed:
            print("```\n" + "\n".join(pushed[:12]) + "\n```\n")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
