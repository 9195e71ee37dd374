"""Queries over the given tables, one per operator, each beside its SQL."""


def registry():
    from checks import changes, checkpoints, evolution, files, flows, recovery, repeats, retention, tables, transforms

    found = {}
    for module in (transforms, changes, checkpoints, files, tables, flows, repeats, recovery, evolution, retention):
        for name, check in module.checks().items():
            if name in found:
                raise ValueError(f"query {name!r} is registered twice")
            found[name] = check
    return found
