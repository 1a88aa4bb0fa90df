"""Connected components and order-dependent constrained components (G-1 to G-5)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.sources.shared import drop
from namewright.sources.shared import keep as kept


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label): the smallest node that each node of ``edges`` is connected with.

    Nodes hook onto their smallest smaller neighbour, trees are flattened by pointer jumping, and edges between
    different trees go on; the number of rounds is logarithmic.  What a round leaves behind is deleted.
    """
    edges = kept(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    labels = kept(edges.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("label", F.col("node")))
    while not edges.isEmpty():
        roots = kept(edges.groupBy("u").agg(F.min("v").alias("p")))
        moved = True
        while moved:
            up = roots.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            flat = kept(roots.join(up, "p", "left").select("u", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("m")))
            moved = not flat.where("m").isEmpty()
            drop(roots)
            roots = flat
        named = kept(labels.join(roots.select(F.col("u").alias("label"), "p"), "label", "left").select("node", F.coalesce("p", "label").alias("label")))
        half = edges.join(roots.select("u", "p"), "u", "left").select(F.coalesce("p", "u").alias("x"), "v")
        full = half.join(roots.select(F.col("u").alias("v"), "p"), "v", "left").select("x", F.coalesce("p", "v").alias("y"))
        rest = kept(full.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct())
        drop(edges, labels, roots)
        edges, labels = rest, named
    drop(edges)
    return labels


# Legal forms that end a name, spelled in tokens of letters and digits.
LEGAL_FORMS = (("S A S", "SAS"), ("SAS", "SAS"), ("S A", "SA"), ("SA", "SA"), ("INC", "INC"), ("CORP", "CORP"), ("LLC", "LLC"), ("LTDA", "LTDA"), ("CIA", "CIA"))


def legal_form(key: Column) -> Column:
    """The legal form at the end of a name, whatever its punctuation; the name may be the form alone."""
    spaced = F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(F.upper(key), F.lit("([A-Z0-9]+)")), " "))
    out = F.lit(None).cast("string")
    for spelling, form in reversed(LEGAL_FORMS):
        out = F.when(spaced.endswith(" " + spelling), form).otherwise(out)
    return out


def replay(edges: pd.DataFrame) -> pd.DataFrame:
    """Links of one plain component in their order: (resolution_key, component, rules, blocked).

    Keys are numbered in their order and legal forms are bits, so a set is an integer: the forms that it holds.  A link of phase 0 is
    refused where both sets hold forms and share none.  A set is named by its smallest number, which is its smallest key.
    """
    edges = edges.sort_values(["phase", "key_a", "key_b"])
    keys, number = np.unique(np.concatenate([edges.key_a, edges.key_b]).astype(object), return_inverse=True)
    bit = {form: 1 << k for k, form in enumerate(sorted({f for f in (*edges.form_a, *edges.form_b) if f}))}
    held = [0] * len(keys)
    for n, form in zip(number.tolist(), [*edges.form_a, *edges.form_b], strict=True):
        held[n] = bit.get(form, 0)
    above, half = list(range(len(keys))), len(edges)

    def top(n: int) -> int:
        while above[n] != n:
            above[n] = n = above[above[n]]
        return n

    blocked, used = 0, []
    for a, b, phase, rule in zip(number[:half].tolist(), number[half:].tolist(), edges.phase.tolist(), edges.decision_rule.tolist(), strict=True):
        x, y = top(a), top(b)
        if phase == 0 and x != y and held[x] and held[y] and not held[x] & held[y]:
            blocked += 1
            continue
        low, high = min(x, y), max(x, y)
        above[high] = low
        held[low] |= held[high]
        if phase == 0:
            used.append((a, rule))
    rules: dict[int, set[str]] = {}
    for a, rule in used:
        rules.setdefault(top(a), set()).add(rule)
    roots = [top(n) for n in range(len(keys))]
    return pd.DataFrame(
        {
            "resolution_key": keys,
            "component": [keys[r] for r in roots],
            "rules": ["|".join(sorted(rules.get(r, ()))) for r in roots],
            "blocked": [blocked if n == 0 else 0 for n in range(len(keys))],
        }
    )


def constrained_components(keys: DataFrame, decisions: DataFrame, public_links: DataFrame | None = None) -> DataFrame:
    """(resolution_key, component, rules, blocked) of every key.

    ``decisions`` (key_a, key_b, decision_rule) are applied in key order, each refused where it would join two
    disjoint legal forms; ``public_links`` (key_a, key_b) follow, none of them refused, so that their own order
    does not matter.  The outcome depends on the order of decisions, so links are replayed in sequence where it can matter: in plain
    components of two legal forms or more.  All others are their own result.  The constraint only ever looks at one component.
    A component is the smallest key in it.
    """
    links = decisions.select("key_a", "key_b", "decision_rule", F.lit(0).alias("phase"))
    if public_links is not None:
        links = links.unionByName(public_links.select("key_a", "key_b", F.lit("").alias("decision_rule"), F.lit(1).alias("phase")))
    for side in "ab":
        links = links.join(keys.select(F.col("resolution_key").alias(f"key_{side}")), f"key_{side}", "left_semi")
    links = kept(links.withColumns({"form_a": legal_form(F.col("key_a")), "form_b": legal_form(F.col("key_b"))}))
    plain = connected(links, "key_a", "key_b").withColumnRenamed("node", "key_a")
    # Only a component in which two legal forms meet can hold a refused link; all others are as they are, and no task sees them whole.
    named = kept(links.join(plain, "key_a"))
    forms = F.explode(F.array_compact(F.array("form_a", "form_b")))
    mixed = kept(named.select("label", forms.alias("form")).groupBy("label").agg(F.count_distinct("form").alias("n")).where("n > 1").select("label"))
    replayed = named.join(mixed, "label", "left_semi").groupBy("label").applyInPandas(replay, "resolution_key string, component string, rules string, blocked int")
    rules = named.join(mixed, "label", "left_anti").where("phase = 0").groupBy("label").agg(F.array_join(F.array_sort(F.collect_set("decision_rule")), "|").alias("rules"))
    simple = plain.join(mixed, "label", "left_anti").join(rules, "label", "left")
    joined = simple.select(F.col("key_a").alias("resolution_key"), F.col("label").alias("component"), "rules", F.lit(0).alias("blocked")).unionByName(replayed)
    return keys.select("resolution_key").join(joined, "resolution_key", "left").select(
        "resolution_key", F.coalesce("component", "resolution_key").alias("component"), F.coalesce("rules", F.lit("")).alias("rules"), F.coalesce("blocked", F.lit(0)).alias("blocked")
    )
