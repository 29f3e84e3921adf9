"""

    python tools/bench_table.py bench.json   # prints markdown
"""

from __future__ import annotations

import json
import sys

# Reference (Redshift) query times, read by eye from its charts; see the table above.
REFERENCE = {"one_dim": ("≈6.4", "≈1.3", "+79 %"), "two_dim": ("≈6.1", "≈7.6", "-23 %"),
             "drill": ("≈5.5", "≈0.7", "+87 %"), "same_dist": ("≈11.7", "≈8.6", "+26 %")}
OTHER = ["star_revenue", "snowflake_revenue", "olap_cube", "olap_cube_naive", "olap_base", "phase_by_flag",
         "sessions_sql", "log_parse", "upsert_latest", "fk_orphans"]


def render(b: dict, title: str) -> str:
    q, loads, gain = b["queries"], b["loads"], b["layout_gain_pct"]
    out = [f"## {title}", "",
           f"`python bench.py` at sf{b['sf']} on `local[{b['cpus']}]` (single JVM); median of {b['runs']} runs after one",
           "warm-up; queries run into the `noop` sink. Redshift numbers are the reference's (2 × dc2.large, unknown SF),",
           "given for direction only.", "",
           "| SSB query | ours plain (s) | ours dist (s) | ours gain | reference plain (s) | reference keyed (s) | reference gain |",
           "| --- | --- | --- | --- | --- | --- | --- |"]
    for k, (rp, rd, rg) in REFERENCE.items():
        out.append(f"| {k} | {q['ssb_' + k + '_plain']} | {q['ssb_' + k + '_dist']} | {gain[k]:+.1f} % | {rp} | {rd} | {rg} |")
    out += ["", "| Other query | seconds |", "| --- | --- |"]
    out += [f"| {k} | {q[k]} |" for k in OTHER if k in q]
    out += ["", f"| Load (sf{b['sf']}) | plain (s) | dist (s) |", "| --- | --- | --- |"]
    for t in ("customer", "dwdate", "supplier", "part", "lineorder"):
        out.append(f"| {t} | {loads['load_' + t + '_plain']} | {loads['load_' + t + '_dist']} |")
    out.append(f"| star (5 tables, fact partitioned by year) | {loads['load_star']} | |")
    out += ["", f"Star vs 3NF (the reference's untimed S6 comparison): revenue by item, month and city takes "
                f"{q['star_revenue']} s on the stored star and {q['snowflake_revenue']} s from the 3NF tables; "
                f"cube vs naive union: {q['olap_cube']} s vs {q['olap_cube_naive']} s. Total of medians: {b['value']} s.", ""]
    if b.get("all_keys"):
        slow = sorted(b["all_keys"].items(), key=lambda kv: -kv[1])[:8]
        out += [f"All {len(b['all_keys'])} registered keys, one timed run each after a warm-up: "
                f"{b['all_keys_total']} s in total; slowest: "
                + ", ".join(f"`{k}` {v} s" for k, v in slow) + ".", ""]
    return "\n".join(out)


if __name__ == "__main__":
    print(render(json.load(open(sys.argv[1])), sys.argv[2] if len(sys.argv) > 2 else "Our bench"))
