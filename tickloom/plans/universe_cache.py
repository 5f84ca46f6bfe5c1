"""The universe document of a day: selection of all venues, its cache files and when they may be used again."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from tickloom.operators import universe
from tickloom.schemas import FUTURES, SPOT
from tickloom.sources import raw

#: Names the rules by which a document was selected; documents of other rules are selected again.
POLICY = "tickloom-1"
UNSUPPORTED = {SPOT: universe.SPOT_UNSUPPORTED, FUTURES: universe.FUTURES_UNSUPPORTED}
POOLS = {SPOT: universe.SPOT_POOL, FUTURES: universe.FUTURES_POOL}


def document(tickers: dict[str, DataFrame], trading: dict[str, DataFrame], excluded: dict[str, DataFrame], timestamp: str, top: int = universe.TOP) -> dict:
    """SNK-10: symbols and selection metadata per venue. What reaches the driver is at most the pool of a venue."""
    out: dict = {"timestamp": timestamp, "top_count": top, "filter_version": POLICY, "candidate_pool_sizes": POOLS, "selection_metadata": {}}
    for venue, pool in POOLS.items():
        chosen = universe.select(tickers[venue], pool, trading.get(venue), excluded.get(venue), top, UNSUPPORTED[venue])
        out[venue] = [r["symbol"] for r in chosen.selected.orderBy("nth").collect()]
        funnel = chosen.funnel.first().asDict()
        out["selection_metadata"][venue] = funnel | {
            "configured_candidate_pool_size": pool,
            "selected_count": len(out[venue]),
            "support_precheck_available": funnel["support_available"],
            "replacement_symbols": [r["symbol"] for r in chosen.replacements.collect()],
            "rejected": [r.asDict() for r in chosen.rejects.orderBy("rank").limit(universe.SAMPLE).collect()],
        }
    return out


def usable(cached: object, top: int = universe.TOP) -> bool:
    """Whether a cached document fits today's policy, sizes and its own counts: every field that has only one right
    value has it."""
    whole = cached if isinstance(cached, dict) else {}
    about = whole.get("selection_metadata")
    fits = [whole.get("filter_version") == POLICY, whole.get("top_count") == top, isinstance(about, dict)]
    for venue, pool in POOLS.items() if all(fits) else ():
        symbols, stated = whole.get(venue), about.get(venue)
        if isinstance(symbols, list) and isinstance(stated, dict):
            right = {"configured_candidate_pool_size": pool, "support_precheck_available": True, "selected_count": len(symbols)}
            fits.append({k: stated.get(k) for k in right} == right)
        else:
            fits.append(False)
    return all(fits)


def save(spark: SparkSession, doc: dict, root: str, date: str) -> None:
    """The same document in the folder of each venue, where resolve_universe looks for it."""
    for venue in POOLS:
        raw.save_text(spark, f"{root}/universe/{venue}/{date}.json", json.dumps(doc, indent=2))
