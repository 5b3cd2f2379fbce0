"""Command line: ``spark-submit -m`` style, one subcommand per job.

    python -m crawlcorpus convert INPUT... --output DIR
"""

import argparse
import sys

from pyspark.sql import Observation, SparkSession, functions as F

from .operators import langid as L, manifest as MF, sampling as S
from .plans import jobs
from .sources import lists


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="crawlcorpus")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name, text, inputs=True, output=True):
        p = commands.add_parser(name, help=text)
        if inputs:
            p.add_argument("input", nargs="+", metavar="FILE-OR-DIR")
            p.add_argument("--mode", choices=jobs.MODES, default=jobs.MODES[0],
                           help="archives at fault are counted, passed over, or end the run")
        if output:
            p.add_argument("-o", "--output", required=True)
        return p

    command("check", "report whether archives read to their end", output=False)

    p = command("convert", "records to JSON lines")
    p.add_argument("-e", "--extractor", default="blocks",
                   choices=["blocks", "tags", "parser", "main", "random"])
    p.add_argument("-H", "--html", action="store_true")
    p.add_argument("-r", "--refers-to", action="store_true")
    p.add_argument("-s", "--sample", type=float)
    p.add_argument("--seed", type=int, default=S.FIRST_SEED)
    p.add_argument("-t", "--text-only", action="store_true")
    p.add_argument("--stop-words", help="file of words, for --extractor main")

    p = command("hashes", "digests of texts")
    p.add_argument("-r", "--refers-to", action="store_true")
    p.add_argument("-n", "--no-norm", action="store_true")

    p = command("extract", "texts of responses")
    p.add_argument("-i", "--ids", metavar="ID[,ID...]")
    p.add_argument("-r", "--raw", action="store_true")
    p.add_argument("-x", "--xml", action="store_true")

    def language(p):
        p.add_argument("-l", "--language")
        p.add_argument("-p", "--lang-prob", type=float, default=L.DOCUMENT_PROB)
        p.add_argument("-m", "--model", help="folder of a trained model")

    p = command("sample", "sample responses into archives")
    p.add_argument("--ratio", type=float, required=True)
    p.add_argument("-s", "--seed", type=int)
    p.add_argument("--input-root", help="mirror the input tree below this folder")
    language(p)

    p = command("sample-crawl", "sample the archives of a path list", inputs=False)
    p.add_argument("paths")
    p.add_argument("--ratio", type=float, default=0.1)
    p.add_argument("--base", default="", help="put before each path")
    p.add_argument("--limit", type=int, help="archives of this run; all that are left if absent")
    language(p)

    p = command("filter", "records with listed ids into archives")
    p.add_argument("--ids", required=True)
    p.add_argument("-r", "--refers-to", action="store_true")
    p.add_argument("--input-root")
    p.add_argument("--index", help="folder of an index of the inputs, to read listed records only")

    command("index", "place and ids of each record, for filter --index")

    p = command("duplicates", "responses whose text was seen before")
    p.add_argument("--db", required=True, help="folder of the index")

    p = command("train", "language model from a table of lang and text", inputs=False)
    p.add_argument("table")

    p = command("select-language", "decide which texts to keep")
    p.add_argument("-m", "--model", required=True)
    p.add_argument("--label", default=L.TARGET)
    p.add_argument("--keep-words", type=int, default=L.KEEP_WORDS)
    p.add_argument("--keep-ratio", type=float, default=L.KEEP_RATIO)
    p.add_argument("--min-ratio", type=float, default=L.MIN_RATIO)
    p.add_argument("--max-labels", type=int, default=L.MAX_LABELS)
    p.add_argument("--min-pred-words", type=int, default=L.MIN_PRED_WORDS)
    p.add_argument("--threshold", type=float, default=L.THRESHOLD)
    p.add_argument("--word-regex", default=L.X.DEFAULT_WORD_PATTERN)

    p = command("common-prefix", "longest common prefix of lines", output=False)
    p.add_argument("-d", "--dir", action="store_true")
    return top


def _run(spark: SparkSession, a: argparse.Namespace):
    def model():
        return L.LanguageModel.load(spark, a.model) if a.model else None

    match a.command:
        case "check":
            return jobs.report(jobs.check(spark, a.input, a.mode))
        case "convert":
            words = []
            if a.stop_words:  # a parameter of the method: some hundreds of words
                words = [r.id for r in lists.id_list(spark, a.stop_words).collect()]
            return jobs.convert(spark, a.input, a.output, extractor=a.extractor, html=a.html,
                                refers_to=a.refers_to, sample=a.sample, seed=a.seed,
                                text_only=a.text_only, stoplist=words, mode=a.mode)
        case "hashes":
            return jobs.compute_hashes(spark, a.input, a.output, refers_to=a.refers_to,
                                       normalize=not a.no_norm, mode=a.mode)
        case "extract":
            return jobs.extract_text(spark, a.input, a.output, ids=a.ids, raw=a.raw, xml=a.xml,
                                     mode=a.mode)
        case "sample":
            return jobs.sample_responses(
                spark, a.ratio, a.input, a.output, seed=a.seed, language=a.language,
                lang_prob=a.lang_prob, model=model(), input_root=a.input_root, mode=a.mode)
        case "sample-crawl":
            counts = {}
            jobs.sample_crawl(
                spark, lists.path_list(spark, a.paths), a.ratio, a.output, base=a.base, counts=counts,
                language=a.language, lang_prob=a.lang_prob, model=model(), limit=a.limit)
            return counts
        case "filter":
            return jobs.filter_by_ids(spark, a.ids, a.input, a.output, refers_to=a.refers_to,
                                      input_root=a.input_root, index=a.index, mode=a.mode)
        case "index":
            return jobs.index(spark, a.input, a.output, a.mode)
        case "duplicates":
            seen = Observation("duplicates")
            jobs.K.write_tsv(jobs.find_duplicates(spark, a.input, a.db, a.mode, seen), a.output)
            return seen.get
        case "train":
            return L.train(spark.read.load(a.table).select("lang", "text")).save(a.output)
        case "select-language":
            return jobs.select_language(
                spark, model(), a.input, a.output, label=a.label, keep_words=a.keep_words,
                keep_ratio=a.keep_ratio, min_ratio=a.min_ratio, max_labels=a.max_labels,
                min_words=a.min_pred_words, threshold=a.threshold, pattern=a.word_regex,
                mode=a.mode)
        case "common-prefix":
            strings = lists.lines(spark, *a.input)
            found = MF.common_directory(strings) if a.dir else MF.common_prefix(strings)
            return found.select(F.col("prefix").alias("value"))


def main(argv=None) -> None:
    arguments = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"crawlcorpus {arguments.command}").getOrCreate()
    result = _run(spark, arguments)
    if isinstance(result, dict):
        print(", ".join(f"{n} {name}" for name, n in result.items()), file=sys.stderr)
    elif result is not None:
        for row in result.toLocalIterator():  # report lines, one partition at a time
            print(*row, sep="\t")


if __name__ == "__main__":
    main()
