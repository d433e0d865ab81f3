"""``python -m lectern TOPIC``: from a folder of books to tables and documents, or a range of the stages."""

from __future__ import annotations

import argparse
import os
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from lectern.plans import pipeline
from lectern.plans.provider import HttpProvider, ModelError
from lectern.plans.stages import Models
from lectern.sources.books import NoSources, valid_topic


def read_settings(path: str) -> dict[str, str]:
    """``NAME=value`` lines of a file; comments and blank lines are passed over, quotation marks taken off. What the environment has already wins."""
    if not Path(path).is_file():
        return dict(os.environ)
    lines = (line.strip().removeprefix("export ") for line in Path(path).read_text(encoding="utf-8").splitlines())
    pairs = (line.partition("=") for line in lines if line and not line.startswith("#") and "=" in line)
    return {name.strip(): value.strip().strip("'\"") for name, _, value in pairs} | dict(os.environ)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="lectern")
    out.add_argument("topic")
    out.add_argument("--books", default="book", help="the folder of topics")
    out.add_argument("--out", default="artifacts", help="where the tables are published")
    out.add_argument("--most", type=int, default=6000, help="characters from which a section is cut")
    out.add_argument("--cap", type=int, default=6000, help="characters that one call may be sent")
    out.add_argument("--first", choices=pipeline.STAGES, help="the first stage to run")
    out.add_argument("--last", choices=pipeline.STAGES, default="inventory", help="the last stage to run")
    out.add_argument("--languages", default=",".join(pipeline.LANGUAGES), help="languages of the documents, the first being the one the others are compared with")
    out.add_argument("--lexicon", help="a JSON file of further buckets and patterns")
    out.add_argument("--prompts", help="a folder of prompts, one file for each stage")
    out.add_argument("--examples", help="a folder of examples, one file for each stage")
    out.add_argument("--model", default="model")
    out.add_argument("--base-url", help="a chat completion endpoint")
    out.add_argument("--key-name", default="LECTERN_API_KEY", help="the setting that holds the key")
    out.add_argument("--settings", default=".env", help="a file of settings")
    out.add_argument("--force", action="store_true", help="ask again for what is in the cache")
    out.add_argument("--dry-run", action="store_true", help="name the stages only")
    return out


def models_of(given: argparse.Namespace) -> Models | None:
    if not given.base_url:
        return None
    provider = HttpProvider(given.base_url, given.model, read_settings(given.settings).get(given.key_name, ""))
    return Models(provider, given.model, pipeline.read_prompts(given.prompts, given.examples) if given.prompts else {}, force=given.force)


def main(args: list[str] | None = None, models: Models | None = None) -> int:
    """0 if all went well, 2 for a wrong name or nothing to read, 3 if the model failed, 4 if a stage's result can't be taken."""
    given = parser().parse_args(args)
    try:
        valid_topic(given.topic)
        if given.dry_run:
            print("\n".join(pipeline.stages_between(given.first, given.last)))
            return 0
        spark = SparkSession.builder.getOrCreate()
        job = pipeline.Run(
            spark, given.books, given.topic, f"{given.out}/{given.topic}", models or models_of(given), pipeline.read_lexicon(given.lexicon), given.most, given.cap, tuple(given.languages.split(","))
        )
        done = pipeline.run(job, given.first, given.last)
    except (NoSources, ValueError) as error:
        print(error, file=sys.stderr)
        return 2
    except ModelError as error:
        print(error, file=sys.stderr)
        return 3
    except pipeline.StageFailed as error:
        print(error, file=sys.stderr)
        return 4
    print(f"{', '.join(done)}: {job.read('sections').count()} sections, {job.read('pairs').count()} pairs")
    return 0


if __name__ == "__main__":
    sys.exit(main())
