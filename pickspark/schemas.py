"""Schemas of stored tables. Times are UTC without zone."""

PICK = (
    "tid string, cha string, pha string, start_ts timestamp_ntz, peak timestamp_ntz, end_ts timestamp_ntz, "
    "conf float, amp float, amp_raw float, rid string, network string, year int, month int"
)
CLASSIFY = "tid string, cha string, start_ts timestamp_ntz, label string, eq float, px float, su float, rid string, network string, year int, month int"
COVERAGE = "tid string, cha string, yr int, doy int, npks long, nclfs long, rid string"
STATION = (
    "id string, network_code string, station_code string, location_code string, latitude double, longitude double, "
    "elevation double, start_date string, end_date string, channels string"
)
RUN = "rid string, model string, weight string, p_threshold double, s_threshold double, components_loaded string, timestamp string"
UNIT = "shard_id string, stations array<string>, start string, end string, n_station_days long"
MANIFEST = (
    "job_id string, run_id string, n_picks long, n_classifies long, station_days long, written_at string, "
    "files array<struct<kind:string,path:string,rows:long,network:string,year:int,month:int>>, "
    "records array<struct<tid:string,cha:string,yr:int,doy:int,rid:string,npks:long,nclfs:long>>, "
    "attempt string, removes array<string>, forgets array<string>"
)
TRACE = "trace_id string, component string, t0 timestamp_ntz, rate double, samples array<float>"

#: What makes a pick, a classification, or a coverage row the same.
PICK_KEY = ["tid", "cha", "pha", "peak"]
CLASSIFY_KEY = ["tid", "cha", "start_ts"]
COVERAGE_KEY = ["tid", "cha", "yr", "doy"]
PARTITIONS = ["network", "year", "month"]
