from cases import frame

from quotefuse.llm import license_scan as ls

PROSE = "granted conditions domain fee purpose charge redistribution restriction unencumbered binary associated documentation"


def test_common_licences_in_files_with_many_licence_words(spark):
    """Every template is found in a file that holds the words of all, however common its own are."""
    every = ". ".join(t for _, t, _ in ls.TEMPLATES)
    common = [(100 + i, t) for i, t in enumerate([t for _, t, _ in ls.TEMPLATES] * 3)]
    mit = "Released under the MIT License."
    rows = [(1, every), (2, f"{PROSE} {mit}"), (3, f"{PROSE} mit"), (4, f"{PROSE} licensed under CC BY-NC 4.0")] + common + [
        (500 + i, mit + " Licensed under CC BY-NC 4.0") for i in range(50)]
    got = {r["doc_id"]: r for r in ls.scan(frame(spark, rows)).collect()}
    assert set(got[1]["labels"].split(",")) == {n for n, _, _ in ls.TEMPLATES} | {n for _, n in ls.PHRASES}
    assert got[2]["labels"] == "mit,mit-notice" and got[2]["score"] == 1.0
    assert got[3]["labels"] == "" and got[3]["score"] == 0.0
    assert got[4]["labels"] == "cc-by,cc-by-nc-notice"
