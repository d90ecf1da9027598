"""Regenerate PLANS.md from `python tools/show_plans.py` output.

usage: python tools/show_plans.py > plans.txt 2>/dev/null; python tools/plans_md.py plans.txt > PLANS.md
"""

import re
import sys


def cut(s, n=60):
    lines = [line[:170] for line in s.strip().splitlines()]
    return "\n".join(lines[:n]) + ("\n   ..." if len(lines) > n else "")


def main():
    txt = open(sys.argv[1], encoding="utf-8", newline="").read()
    # the set's own line ends are lost in print
    txt = re.sub(r"instr\(\s+, substring", "instr(WS, substring", txt)
    txt = re.sub(r"Some\(\s+\)", "Some(WS)", txt)
    txt = re.sub(r"#\d+L?", "", txt)
    txt = re.sub(r", \[plan_id=\d+\]", "", txt)
    sections = re.split(r"^===== (\w+)\n", txt, flags=re.M)[1:]
    plans = dict(zip(sections[0::2], sections[1::2]))
    print(f"""# Physical plans of the prepare job

Produced by `python tools/show_plans.py` and `tools/plans_md.py` (sf0.01, `docs_capped` with cap 40 so
exact-n sampling binds, AQE off so every exchange is visible; expression ids removed, `WS` = the 29-character
whitespace set). With AQE on (the default) small shuffles coalesce and broadcasts are re-planned at run time;
the shape below is what a cluster starts from.

## 1. `samples` — scan, A1 exact-n sample, render/strip/band, J1 config join (written as a table)

* The rows that are sampled are scanned once, with the source filter pushed; each is compared with its source's
  threshold (key, id), one broadcast row per source. No text is exchanged.
* The thresholds come from a second scan that reads only `doc_id, source`: bucket counts, the bucket that holds
  the n-th id of each source (one broadcast row per source), and a window over that bucket alone.
* Strip and the length band are evaluated on the scan side; J1 (config) is a broadcast of a
  one-row-per-source table.

```
{cut(plans['samples'], 70)}
```

## 2. `mixed` — A2 fraction mix on the narrow projection of the stored samples

Reads only `source, sample_id, source_ord, text_hash` from the samples table (column pruning on our own
Parquet); the same threshold filter as A1 with `stage = mix`, then the exact rank of the narrow rows that pass;
adds `ord_key` (O1's seeded order).

```
{cut(plans['mixed'], 45)}
```

## 3. `survivors` and `index` — G1 keep-first dedup and O1 positions, narrow

`min(struct(ord_key, sample_id, ...))` per `text_hash` with a partial (map-side) sort aggregate, so a hot
duplicate text is combined before the one shuffle; no join. The survivors are written, so counting and ranking
read them twice instead of deduplicating twice. Positions: bucket counts over `ord_key` prefixes (the only
un-partitioned window is over this ≤16^h-row count table), then `row_number`
per bucket.

```
{cut(plans['survivors'], 30)}

{cut(plans['index'], 60)}
```

## 4. `corpus` — one join of the selected text onto the narrow index

The text side passes the sample's and the mix's thresholds at the scan, so only selected rows reach the join on
the unique `sample_id`; Spark broadcasts the index where its files are small, else both sides are exchanged.

```
{cut(plans['corpus'], 30)}
```

## 5. Train input — T1 tokenize, B1 epochs, B3 length-grouped batches

Tokens are built-in expressions (`split(text, '')`, ids for the first max_seq_length tokens), epochs are an
`explode`, positions per epoch use the bucketed rank grouped by epoch, and the B3 window is per
`(epoch, mega-batch)` — at most `batch × accumulation × 50` rows per window partition.

```
{cut(plans['batches'], 50)}
```""")


if __name__ == "__main__":
    main()
