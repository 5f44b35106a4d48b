"""Multi-row headers, headerless files and the results sink, on generated files."""

import pytest

from tabloom.sources import delimited as D

TRACKS = """,album,album,artist,track,track,track,track
,comments,title,name,date_created,duration,genre_top,listens
track_id,,,,,,,
2,0,"A, one",X,2008-11-26,168,Hip-Hop,1293
3,0,B,Y,11/27/2008,237,,514
5,,C,,not a date,,Rock,1151
"""
FEATURES = """feature,mfcc,mfcc,mfcc,tonnetz,zcr
statistics,mean,mean,std,mean,mean
number,01,02,01,01,01
track_id,,,,,
2,-163.7,116.6,20.1,0.02,0.08
3,-159.0,120.1,21.3,,0.07
10,-205.4,132.2,19.9,0.05,NaN
"""


@pytest.fixture
def files(tmp_path):
    (tmp_path / "tracks.csv").write_text(TRACKS)
    (tmp_path / "features.csv").write_text(FEATURES)
    return str(tmp_path / "tracks.csv"), str(tmp_path / "features.csv")


def test_tracks(spark, files):
    df = D.read_tracks(spark, files[0]).orderBy("track_id")
    assert df.columns == ["track_id", "track_date_created", "track_duration", "track_genre_top", "track_listens"]
    assert dict(df.dtypes)["track_listens"] == "bigint"
    assert [tuple(r) for r in df.collect()][1:] == [
        ("3", "11/27/2008", 237, None, 514),
        ("5", "not a date", None, "Rock", 1151),
    ]
    with pytest.warns(UserWarning, match="nothing"):
        assert D.read_tracks(spark, files[0], ["listens", "nothing"]).columns == ["track_id", "track_listens"]


def test_features(spark, files):
    df = D.read_features(spark, files[1])
    assert df.columns == ["track_id", "mfcc_mean_01", "mfcc_mean_02", "mfcc_std_01", "tonnetz_mean_01", "zcr_mean_01"]
    rows = {r["track_id"]: r for r in df.collect()}
    assert rows["3"]["tonnetz_mean_01"] is None and rows["10"]["zcr_mean_01"] is None
    assert len(D.read_features(spark, files[1], ["mfcc"]).columns) == 4
    with pytest.raises(ValueError, match="bandwith"):
        D.read_features(spark, files[1], ["mfcc", "bandwith"])


def test_keys_of_any_kind(spark, tmp_path):
    """No line below the headers is lost, whatever its key; header lines go wherever they stand."""
    path = tmp_path / "tracks.csv"
    path.write_text(",track,track\n,listens,title\ntrack_id,,\nA1,5,x\n007,NA,y\n,7,\nA1,5,x\n,track,track\ntrack_id,8,z\n2,oops,NaN\n")
    rows = D.read_multi_header(spark, str(path), D.TRACKS_LAYOUT, types={"track_listens": "bigint"}).collect()
    assert [tuple(r) for r in rows] == [
        ("A1", 5, "x"), ("007", None, "y"), (None, 7, None), ("A1", 5, "x"), ("track_id", 8, "z"), ("2", None, None),
    ]
    with pytest.raises(Exception, match="does not parse as bigint: A1"):
        D.read_multi_header(spark, str(path), D.TRACKS_LAYOUT, key_type="bigint").collect()


def test_join_and_datasets(spark, files):
    joined = D.read_tracks_and_features(spark, *files, columns=["listens"], groups=["mfcc"])
    assert sorted(r["track_id"] for r in joined.collect()) == ["2", "3"]
    assert joined.columns == ["track_id", "track_listens", "mfcc_mean_01", "mfcc_mean_02", "mfcc_std_01"]
    tracks, features = D.read_datasets(spark, *files, layout=D.THREE_ROW_LAYOUT)
    assert "album_title" in tracks.columns and features.count() == 3
    assert tracks.where("track_id = 2").first()["album_title"] == "A, one"


def test_repeated_names_get_a_suffix():
    layout = D.HeaderLayout(2, (0, 1))
    assert D.column_names([["", "a", "a", "a"], ["", "x", "x", "y"]], layout) == ["track_id", "a_x", "a_x_1", "a_y"]


def test_missing_file_names_the_path(spark):
    with pytest.raises(FileNotFoundError, match="/no/such"):
        D.read_tracks(spark, "/no/such/file.csv")


def test_headerless(spark, tmp_path):
    (tmp_path / "plain.data").write_text("0.1,0.2,M\n0.3,0.4,R\n\n")
    df = D.boolean_label(D.read_headerless(spark, str(tmp_path / "plain.data"), 3), "_c2", "M", "mine")
    assert sorted(tuple(r) for r in df.collect()) == [(0.1, 0.2, "M", True), (0.3, 0.4, "R", False)]


def test_results_round_trip(spark, tmp_path):
    rows = [("a", "SVC", '{"cost": 0.1, "kernel": "linear"}', 0.5, [[1, 2], [3, 4]])]
    df = spark.createDataFrame(rows, "approach string, model string, config string, accuracy double, cm array<array<bigint>>")
    D.write_results(df, str(tmp_path / "r"))
    back = D.read_results(spark, str(tmp_path / "r"), "approach string, model string, config string, accuracy double, cm string")
    assert tuple(back.first()) == ("a", "SVC", '{"cost": 0.1, "kernel": "linear"}', 0.5, "[[1,2],[3,4]]")
    D.write_results(df, str(tmp_path / "p"), "parquet")
    assert spark.read.parquet(str(tmp_path / "p")).first()["cm"] == [[1, 2], [3, 4]]
    with pytest.raises(ValueError):
        D.write_results(df, str(tmp_path / "x"), "xml")
