"""Small crate documents in the shape the tables are read from."""

import json

E = "https://w3id.org/EVI#"
P = "ark:99999/"


def ref(*ids):
    return [{"@id": i} for i in ids]


def _entity(i, kind, classes, **keys):
    return {"@id": i, "@type": [*classes, E + kind], "name": i.rpartition("/")[2], **keys}


def dataset(i, fmt="txt", by=None, **keys):
    if by is not None:
        keys["generatedBy"] = ref(by) if isinstance(by, str) else by
    return _entity(i, "Dataset", ["prov:Entity"], format=fmt, **keys)


def software(i, **keys):
    return _entity(i, "Software", ["prov:Entity"], **keys)


def computation(i, used=(), soft=(), made=(), **keys):
    return _entity(i, "Computation", ["prov:Activity"], usedDataset=ref(*used), usedSoftware=ref(*soft), generated=ref(*made)) | keys


def document(root, *entities, **root_keys):
    top = {"@id": root, "@type": ["Dataset", E + "ROCrate"], "name": "a crate", **root_keys}
    about = {"@id": "ro-crate-metadata.json", "@type": "CreativeWork", "conformsTo": {"@id": "https://w3id.org/ro/crate/1.2"}, "about": {"@id": root}}
    return json.dumps({"@context": {}, "@graph": [about, top, *entities]})


def forecast(members=8):
    """An ensemble forecast: every member perturbs the analysis by a seed of its own and runs the model in two
    steps; a blend weights all members by the verification of last week and gives a map and a table."""
    ents = [software(P + s) for s in ("perturb", "model", "blend")]
    ents += [dataset(P + "analysis", "grib"), dataset(P + "verification", "csv")]
    for i in range(members):
        m = f"{P}m{i:02d}"
        ents += [dataset(m + "-seed", "bin"), computation(m + "-perturb", [P + "analysis", m + "-seed"], [P + "perturb"], [m + "-start"]),
                 dataset(m + "-start", "grib", m + "-perturb"), computation(m + "-run", [m + "-start"], [P + "model"], [m + "-field"]), dataset(m + "-field", "nc", m + "-run")]
    fields = [f"{P}m{i:02d}-field" for i in range(members)]
    ents += [computation(P + "blend-1", [P + "verification", *fields], [P + "blend"], [P + "map", P + "table"], name="Blend"),
             dataset(P + "map", "png", P + "blend-1"), dataset(P + "table", "csv", P + "blend-1")]
    return document(P + f"forecast-{members}", *ents)


def diamond():
    """A survey cleaned twice from one raw file; both results meet in a report that only one of them needs
    a codebook for. The raw file has no producer."""
    return document(
        P + "survey", software(P + "clean"), software(P + "tally"), software(P + "idle"), dataset(P + "raw", "sav"), dataset(P + "codebook", "pdf"),
        computation(P + "strict", [P + "raw"], [P + "clean"], [P + "core"]), computation(P + "lenient", [P + "raw", P + "codebook"], [P + "clean"], [P + "wide"]),
        dataset(P + "core", "csv", P + "strict"), dataset(P + "wide", "csv", P + "lenient"),
        computation(P + "report", [P + "core", P + "wide"], [P + "tally"], [P + "figures"]), dataset(P + "figures", "json", P + "report"), license="CC0")
