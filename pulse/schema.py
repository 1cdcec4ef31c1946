"""Table schemas. Times are UTC instants; parsed-name metadata stays JSON text."""

TORRENTS = (
    "infohash string, filename string, pubdate timestamp, size_bytes bigint, source_id bigint, "
    "trusted boolean, remake boolean, status string, guessit_data string"
)
STATS = "infohash string, timestamp timestamp, seeders int, leechers int, downloads bigint"
RATING_PAYLOAD = (
    "struct<score:double,scored_by:bigint,rank:int,popularity:int,members:bigint,favorites:bigint>"
)
RATINGS = (
    "source string, anilist_id bigint, mal_id bigint, "
    f"payload {RATING_PAYLOAD}, "
    "fetched_at timestamp"
)
SURVEYS = (
    "anilist_id bigint, episode bigint, very_good_pct double, good_pct double, normal_pct double, "
    "bad_pct double, very_bad_pct double, mean_score double, source_url string, fetched_at timestamp"
)
MEDIA = (
    "id bigint, idMal bigint, title struct<romaji:string,english:string,native:string>, "
    "synonyms array<string>, episodes int, status string, format string, "
    "airingSchedule struct<nodes:array<struct<episode:int,airingAt:bigint>>>, "
    "coverImage struct<large:string,color:string>, "
    "startDate struct<year:int,month:int,day:int>, averageScore int, meanScore int, "
    "popularity bigint, favourites bigint"
)
FEED_ITEM = (
    "title string, guid string, pubDate string, seeders string, leechers string, "
    "downloads string, infoHash string, size string, trusted string, remake string"
)
