"""Commands: stats, verify, pack and validate."""

from __future__ import annotations

import argparse
import json
import sys

from .sources.sinks import pack_release, rights_note, verify_archive


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="corvane")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("stats", help="resources and artifacts of a catalogue")
    c.add_argument("catalogue")
    c = sub.add_parser("validate", help="derive a release again from its files")
    c.add_argument("root")
    c = sub.add_parser("pack", help="pack a release folder")
    c.add_argument("root")
    c.add_argument("output")
    c = sub.add_parser("verify", help="verify a packed release")
    c.add_argument("archive")
    c.add_argument("--sha256", required=True)
    c.add_argument("--manifest-sha256")
    sub.add_parser("notes", help="the release note on rights")
    a = p.parse_args(argv)
    if a.command == "notes":
        print(rights_note())
    elif a.command == "pack":
        print(json.dumps(pack_release(a.root, a.output), indent=2))
    elif a.command == "verify":
        print(json.dumps(verify_archive(a.archive, a.sha256, a.manifest_sha256), indent=2))
    else:
        from .session import session

        spark = session()
        if a.command == "stats":
            from .plans.catalogue import Catalogue

            kinds, artifacts = Catalogue(spark, a.catalogue).stats()
            print(json.dumps({"resources": {r["kind"]: r["n"] for r in kinds.collect()}, "artifacts": artifacts.first().asDict()}, indent=2))
        else:
            from .plans.release import validate_release

            found = [r.asDict() for r in validate_release(spark, a.root).take(100)]
            print(json.dumps(found, indent=2))
            return int(bool(found))
    return 0


if __name__ == "__main__":
    sys.exit(main())
