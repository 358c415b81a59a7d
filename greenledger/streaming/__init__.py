from greenledger.streaming.incremental import arrivals, land_arrivals, landing_summary, run_until_caught_up

__all__ = ["arrivals", "land_arrivals", "landing_summary", "run_until_caught_up"]
