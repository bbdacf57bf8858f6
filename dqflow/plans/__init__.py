from dqflow.plans.dataflow import build_flow, run, write_flow

__all__ = ["build_flow", "run", "write_flow"]
