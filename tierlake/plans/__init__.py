from tierlake.plans.archives import build_bronze_from_archives, load_archives, load_archives_typed
from tierlake.plans.bronze import build_bronze
from tierlake.plans.gold import build_gold, gold_path, gold_tables, read_gold
from tierlake.plans.lake import build_lake, layer_path
from tierlake.plans.quarantine import ingest_rescued, read_quarantine
from tierlake.plans.silver import build_silver, load_presence, presence_path, silver_frame
from tierlake.plans.state import state_gold, state_medians, update_state

__all__ = [
    "build_bronze",
    "build_bronze_from_archives",
    "build_gold",
    "build_lake",
    "build_silver",
    "gold_path",
    "gold_tables",
    "ingest_rescued",
    "layer_path",
    "load_archives",
    "load_archives_typed",
    "load_presence",
    "presence_path",
    "read_gold",
    "read_quarantine",
    "silver_frame",
    "state_gold",
    "state_medians",
    "update_state",
]
