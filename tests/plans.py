"""What a run broadcasts, read off the plans of the frames it writes."""

import contextlib
import io


def plan_of(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def plans_written(monkeypatch, *modules):
    """The plans of all frames that ``modules`` write from now on."""
    plans = []
    for module in modules:
        def kept(df, write=module.saved):
            plans.append(plan_of(df))
            return write(df)

        monkeypatch.setattr(module, "saved", kept)
    return plans
