"""What each registered query must return, in SQL for DuckDB.

Steps follow the meaning of the pipelines as plainly as SQL allows: they rank
and count whole people-by-event pairs, where the Spark side works on places.
"""

from __future__ import annotations

from checks.duck import assemble

# Texts by which an answer is recognised.
UNSUBSCRIBED_TEXT = "This e-mail address is unsubscribed and cannot be delivered to"
INVALID_TEXT = "Must be a valid e-mail address"
ALREADY_DELIVERED_TEXT = "The requested deferred result has already been delivered"
RATE_LIMIT_TEXT = "Rate limit exceeded"

# Letters of other scripts that are spelled by one Latin letter each.
SCRIPTS = {
    "armenian": ("atombiledngfrhys", "ատօմբիլեդնգֆրհյս"),
    "georgian": ("autombiledngfrchs", "აუტომბილედნგჶრცჰს"),
    "hebrew": ("tmbldngrhys", "טמבלדנגרהיס"),
    "arabic": ("atmbldnfrhys", "اتمبلدنفرهيس"),
    "devanagari": ("autombiledngfrchys", "अउतओमबइलएदनग\u095eरचहयस"),
    "tamil": ("automilenrchys", "அஉதஒமஇலஎநரசஹயஸ"),
}
# Sounds of Hangul in the order of their numbers, "-" where there is none.
HANGUL = (
    "g gg n d dd r m b bb s ss - j jj c k t p h",
    "a ae ya yae eo e yeo ye o wa wae oe yo u weo we wi yu eu yi i",
    "- g gg gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j c k t p h",
)

DAY = "DATE '2020-02-12'"
EVENT_DAY = "DATE '2020-02-15'"
NY = "timezone('America/New_York', timezone('UTC', {0}))"
MILES = (
    "2.0 * 3961 * asin(sqrt(least(1.0, pow(sin(radians(({2} - {0}) / 2)), 2)"
    " + cos(radians({0})) * cos(radians({2})) * pow(sin(radians(({3} - {1}) / 2)), 2))))"
)


def _local(ts: str, zone: str) -> str:
    return f"timezone({zone}, timezone('UTC', {ts}))"


_BOTH_IDS = (
    "json_valid(body) AND json_extract_string(body, '$.mailing_recipient_id') IS NOT NULL"
    " AND json_extract_string(body, '$.mailing_send_id') IS NOT NULL"
)

STEPS = {
    "suppressed": """
        SELECT cons_id FROM {suppressed_isp} UNION SELECT cons_id FROM {suppressed_inactive}
        UNION SELECT cons_id FROM {suppressed_seed}""",
    "located": """
        SELECT a.*, CASE WHEN a.latitude IS NULL OR a.latitude = 0 THEN z.latitude
                    ELSE a.latitude END AS lat,
               CASE WHEN a.longitude IS NULL OR a.longitude = 0 THEN z.longitude
                    ELSE a.longitude END AS lon
        FROM {cons_addr} a LEFT JOIN {zips} z ON z.zip = a.zip
        WHERE coalesce(a.latitude, z.latitude) IS NOT NULL
          AND coalesce(a.longitude, z.longitude) IS NOT NULL""",
    "people": """
        SELECT e.email, c.cons_id, c.firstname, c.lastname, a.addr1, a.city, a.state_cd,
               t.state AS state_name, a.zip, a.lat AS latitude, a.lon AS longitude
        FROM {cons_sub} s JOIN {cons_email} e ON e.cons_email_id = s.cons_email_id AND e.is_primary
             JOIN {cons} c ON c.cons_id = s.cons_id
             JOIN {located} a ON a.cons_id = s.cons_id AND a.is_primary = 1
             LEFT JOIN {state_abbr} t ON t.state_abbr = a.state_cd
        WHERE s.isunsub = 0 AND s.chapter_id = 1
          AND NOT EXISTS (SELECT 1 FROM {suppressed} x WHERE x.cons_id = s.cons_id)""",
    "rsvps": """
        SELECT timeslot_id, count(*) AS rsvp_count FROM {participations}
        WHERE status <> 'CANCELLED' GROUP BY timeslot_id""",
    "slots": f"""
        SELECT t.id, t.event_id, t.start_date, t.max_attendees,
               CAST({NY.format("t.start_date")} AS DATE) AS day,
               {_local("t.start_date", "e.timezone")} AS local
        FROM {{timeslots}} t JOIN {{org_events}} e ON e.id = t.event_id
        WHERE t.deleted_date IS NULL
          AND CAST({NY.format("t.start_date")} AS DATE) >= {EVENT_DAY}
          AND CAST({NY.format("t.start_date")} AS DATE) < {EVENT_DAY} + 4""",
    "slot_texts": """
        SELECT *, ltrim(lower(strftime(local, '%I:%M%p')), '0') AS clock,
               strftime(local, '%A') AS weekday, strftime(local, '%A, %B %d') AS local_day,
               'https://events.example.org/event/' || event_id || '/?timeslot=' || id AS url
        FROM {slots}""",
    "days": """
        SELECT event_id, day, min(start_date) AS day_start, count(*) AS n,
               string_agg(url, '|' ORDER BY start_date, id) AS urls,
               string_agg(weekday || ' at ' || clock, '|' ORDER BY start_date, id) AS times,
               string_agg(clock, ' and ' ORDER BY start_date, id) AS clocks
        FROM {slot_texts} GROUP BY event_id, day""",
    "synopses": """
        SELECT event_id, string_agg(synopsis, ' and ' ORDER BY first_start) AS formatted_start_times
        FROM (SELECT s.event_id,
                     s.local_day || CASE WHEN d.n >= 3 THEN '' ELSE ' at ' || d.clocks END AS synopsis,
                     min(s.start_date) AS first_start
              FROM {slot_texts} s JOIN {days} d ON d.event_id = s.event_id AND d.day = s.day
              GROUP BY 1, 2) GROUP BY event_id""",
    "day_lists": """
        SELECT event_id, string_agg(urls, '|' ORDER BY day_start) AS csv_timeslot_urls
        FROM {days} GROUP BY event_id""",
    "time_lists": """
        SELECT event_id, string_agg(times, '|' ORDER BY first_start) AS csv_start_times
        FROM (SELECT event_id, times, min(day_start) AS first_start FROM {days} GROUP BY 1, 2)
        GROUP BY event_id""",
    "next_slots": """
        SELECT f.id AS next_timeslot_id, f.event_id, f.day AS start_date,
               f.start_date AS start_timestamp, f.max_attendees, r.rsvp_count,
               f.max_attendees - coalesce(r.rsvp_count, 0) AS spots_remaining
        FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY start_date, id) AS n
              FROM {slots}) f LEFT JOIN {rsvps} r ON r.timeslot_id = f.id WHERE f.n = 1""",
    "features": f"""
        SELECT e.id AS event_id, e.event_type, e.title AS event_title, e.summary AS event_summary,
               'https://events.example.org/event/' || e.id
                 || '/?utm_source=email-20200212-event_invite' AS event_url,
               e.location__venue AS event_venue,
               CASE WHEN e.location__is_private = 1 THEN '' ELSE e.location__address_line_1 END AS event_addr1,
               e.location__locality AS event_city,
               coalesce(e.location__region, e.organization__state) AS event_state,
               e.location__postal_code AS event_zip,
               coalesce(e.location__lat, z.latitude) AS event_latitude,
               coalesce(e.location__lon, z.longitude) AS event_longitude,
               e.timezone AS event_timezone, n.start_date AS event_start_date,
               {_local("n.start_timestamp", "e.timezone")} AS local,
               dayofweek(n.start_date) AS dayofweek, n.spots_remaining AS event_spots_remaining,
               y.formatted_start_times, u.csv_timeslot_urls, t.csv_start_times
        FROM {{org_events}} e JOIN {{next_slots}} n ON n.event_id = e.id
             JOIN {{synopses}} y ON y.event_id = e.id JOIN {{day_lists}} u ON u.event_id = e.id
             JOIN {{time_lists}} t ON t.event_id = e.id
             LEFT JOIN {{zips}} z ON z.zip = e.location__postal_code
        WHERE e.visibility = 'PUBLIC' AND e.approval_status = 'APPROVED' AND e.deleted_date IS NULL
          AND e.is_virtual <> 1
          AND e.event_type IN ('PHONE_BANK', 'BARNSTORM', 'TRAINING', 'CANVASS', 'COMMUNITY')
          AND n.start_date >= {EVENT_DAY} AND n.start_date < {EVENT_DAY} + 3""",
    "scored": """
        SELECT *, CAST(CASE WHEN dayofweek IN (0, 6) THEN 2 ELSE 1 END
                  * CASE event_type WHEN 'PHONE_BANK' THEN 256 WHEN 'BARNSTORM' THEN 16
                         WHEN 'TRAINING' THEN 16 ELSE 1 END AS INT) AS score_event
        FROM {features}""",
    "pairs": f"""
        SELECT p.cons_id, p.email, e.event_id, e.score_event, e.event_start_date,
               e.event_spots_remaining,
               {MILES.format("p.latitude", "p.longitude", "e.event_latitude", "e.event_longitude")} AS miles
        FROM {{people}} p JOIN {{scored}} e ON e.event_state = p.state_cd
        WHERE {MILES.format("p.latitude", "p.longitude", "e.event_latitude", "e.event_longitude")} < 25""",
    "ratios": """
        SELECT p.*, c.cons_count,
               CASE WHEN event_spots_remaining = 0 THEN 1000000
                    ELSE c.cons_count // event_spots_remaining END AS recipients_per_available_spots
        FROM {pairs} p JOIN (SELECT event_id, count(*) AS cons_count FROM {pairs} GROUP BY event_id) c
             ON c.event_id = p.event_id""",
    "roomy": """
        SELECT *, CASE WHEN miles <= 7 THEN 4 ELSE 1 END * score_event - miles * 0.001::DOUBLE AS score
        FROM {ratios}
        WHERE recipients_per_available_spots IS NULL OR recipients_per_available_spots < 25""",
    "best": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cons_id
                                 ORDER BY score DESC, event_id, email) AS n FROM {roomy})
        WHERE n = 1""",
    "staged": f"""
        SELECT b.* FROM {{best}} b
        WHERE b.event_start_date = {EVENT_DAY}
          AND NOT EXISTS (SELECT 1 FROM {{schedulings}} s WHERE s.email = b.email
                          AND s.mailing_name = 'event_invite' AND s.secondary_id IS NULL
                          AND s.ds BETWEEN {DAY} - 2 AND {DAY} - 1)""",
    "first_starts": f"""
        SELECT t.event_id, min(t.start_date) AS start_timestamp
        FROM {{timeslots}} t JOIN {{org_events}} e ON e.id = t.event_id
        WHERE CAST({NY.format("t.start_date")} AS DATE) >= {DAY} GROUP BY t.event_id""",
    "approved": f"""
        SELECT {DAY} AS ds, e.creator__email_address AS email, e.id AS secondary_id,
               'event_approval' AS mailing_name, e.creator__given_name AS firstname,
               e.creator__family_name AS lastname,
               'https://events.example.org/event/' || e.id AS event_url,
               'https://events.example.org/dashboard/event/' || e.id AS event_dashboard_url,
               e.location__region AS event_state,
               CAST({NY.format("f.start_timestamp")} AS DATE) AS event_start_date,
               strftime({_local("f.start_timestamp", "e.timezone")}, '%Y-%m-%d %H:%M:%S')
                 AS event_start_timestamp_local,
               e.reviewed_date AS event_reviewed_at
        FROM {{org_events}} e JOIN {{first_starts}} f ON f.event_id = e.id
        WHERE e.created_by_volunteer_host = '1' AND e.approval_status = 'APPROVED'
          AND e.deleted_date IS NULL AND e.location__region NOT IN ('R3')
          AND e.reviewed_date >= DATE '1999-12-01'""",
    "approval_staged": """
        SELECT a.* FROM {approved} a
        WHERE NOT EXISTS (SELECT 1 FROM {schedulings} s WHERE s.email = a.email
              AND s.secondary_id = a.secondary_id AND s.mailing_name = a.mailing_name)""",
    "joined": """
        SELECT s.scheduled_at, p.* FROM {schedulings} s JOIN {payloads} p
          ON p.ds = s.ds AND p.cons_id IS NOT DISTINCT FROM s.cons_id AND p.email = s.email
         AND p.secondary_id IS NOT DISTINCT FROM s.secondary_id
        WHERE s.mailing_name = 'event_invite'""",
    "pending": r"""
        SELECT j.* FROM {joined} j
        WHERE NOT regexp_matches(j.email, '[^\x00-\x7F]')
          AND NOT EXISTS (SELECT 1 FROM {sends} d WHERE d.ds = j.ds AND d.email = j.email
              AND d.secondary_id IS NOT DISTINCT FROM j.secondary_id
              AND d.mailing_name = j.mailing_name)""",
    "numbered": """
        SELECT *, row_number() OVER (ORDER BY ds, email, secondary_id NULLS LAST, scheduled_at,
                                     cons_id) - 1 AS position FROM {pending}""",
    "send_outcomes": f"""
        SELECT *, CASE
            WHEN contains(body, '{UNSUBSCRIBED_TEXT}') THEN 'UNSUB'
            WHEN contains(body, '{INVALID_TEXT}') THEN 'INVAL'
            WHEN status = 202 AND body <> '' THEN 'DEFER'
            WHEN status = 503 THEN 'ERROR'
            WHEN {_BOTH_IDS} THEN json_extract_string(body, '$.mailing_recipient_id')
            WHEN json_valid(body) AND body <> '{{{{}}}}' THEN 'PLACE'
            ELSE 'ERROR' END AS recipient,
          CASE WHEN {_BOTH_IDS} THEN json_extract_string(body, '$.mailing_send_id') END AS send,
          CASE WHEN status = 202 AND body <> ''
               THEN json_extract_string(body, '$.deferred_task_id') END AS task
        FROM {{send_responses}}""",
    "deferred_outcomes": f"""
        SELECT *, CASE
            WHEN status = 202 OR contains(body, '{RATE_LIMIT_TEXT}') THEN 'DEFER'
            WHEN contains(body, '{UNSUBSCRIBED_TEXT}') THEN 'UNSUB'
            WHEN contains(body, '{INVALID_TEXT}') THEN 'INVAL'
            WHEN contains(body, '{ALREADY_DELIVERED_TEXT}') THEN 'UNKNO'
            WHEN {_BOTH_IDS} THEN json_extract_string(body, '$.mailing_recipient_id')
            ELSE 'ERROR' END AS recipient,
          CASE WHEN {_BOTH_IDS} THEN json_extract_string(body, '$.mailing_send_id') END AS send,
          CASE WHEN status = 202 OR contains(body, '{RATE_LIMIT_TEXT}')
               THEN deferred_task_id END AS task
        FROM {{deferred_responses}}""",
    # A message that was accepted has the state of its later result.
    "states": """
        SELECT s.ds, s.cons_id, s.email, s.secondary_id, s.mailing_name,
               CASE WHEN s.recipient = 'DEFER' THEN d.recipient ELSE s.recipient END AS recipient,
               CASE WHEN s.recipient = 'DEFER' THEN coalesce(d.send, d.recipient)
                    ELSE coalesce(s.send, s.recipient) END AS send,
               CASE WHEN s.recipient = 'DEFER' THEN d.task ELSE s.task END AS task
        FROM {send_outcomes} s JOIN {deferred_outcomes} d ON d.secondary_id = s.secondary_id""",
}

# The steps of the days after the first: each a day on, and seeing what the days before it staged.
OF_A_DAY = (
    "slots", "slot_texts", "days", "synopses", "day_lists", "time_lists", "next_slots", "features",
    "scored", "pairs", "ratios", "roomy", "best", "staged",
)
# Days of an event window by its first day, from the Saturday of the first event day on.
WINDOW_DAYS = (3, 3, 3, 2, 5, 4, 3, 3)


def _later_day(sql: str, n: int) -> str:
    sql = sql.replace(f"AND n.start_date < {EVENT_DAY} + 3", f"AND n.start_date < {EVENT_DAY} + {WINDOW_DAYS[n]}")
    sql = sql.replace(f"BETWEEN {DAY} - 2 AND {DAY} - 1", f"BETWEEN {DAY} - 2 AND {DAY}")
    # The event day first: on the fourth day, the day is what the event day was.
    sql = sql.replace(EVENT_DAY, f"DATE '2020-02-{15 + n}'").replace(DAY, f"DATE '2020-02-{12 + n}'")
    for name in OF_A_DAY:
        sql = sql.replace(f"{{{name}}}", f"{{{name}_{n + 1}}}")
    return sql.replace("{schedulings}", f"{{schedulings_{n + 1}}}")


def _staged(n: int) -> str:
    return "staged" if n == 0 else f"staged_{n + 1}"


for _n in range(1, len(WINDOW_DAYS)):
    _before = "schedulings" if _n == 1 else f"schedulings_{_n}"
    STEPS[f"schedulings_{_n + 1}"] = f"""
        SELECT ds, email, mailing_name, secondary_id FROM {{{_before}}}
        UNION ALL SELECT DATE '2020-02-{11 + _n}', email, 'event_invite', NULL FROM {{{_staged(_n - 1)}}}"""
    # Only the text of the tracking link names the day, and it is not looked at.
    STEPS |= {f"{name}_{_n + 1}": _later_day(STEPS[name], _n) for name in OF_A_DAY}


def _staged_on(days: int) -> str:
    return " UNION ALL ".join(
        f"""SELECT '2020-02-{12 + n}' AS ds, cons_id, email, event_id,
                   CAST(event_start_date AS VARCHAR) AS event_start_date FROM {{{_staged(n)}}}"""
        for n in range(days)
    )


FIRST_NAME = """CASE WHEN lower(firstname) = 'machinery' THEN 'MacHinery'
    ELSE upper(substr(firstname, 1, 1)) || lower(substr(firstname, 2)) END"""
LAST_NAME = "upper(substr(lastname, 1, 1)) || lower(substr(lastname, 2))"


def _request_json(email: str, *more: str) -> str:
    fields = [
        "scheduled_at := strftime(scheduled_at, '%Y-%m-%d %H:%M:%S')",
        "ds := CAST(ds AS VARCHAR)",
        "cons_id := CAST(CASE WHEN cons_id = 0 THEN '\"\"' ELSE CAST(cons_id AS VARCHAR) END AS JSON)",
        f"email := {email}", "secondary_id := ''", "mailing_name := mailing_name",
        "cons_city := cons_city", "cons_state := cons_state", "cons_zip := cons_zip",
        "distance_to_event := CAST(CASE WHEN distance_to_event = 0 THEN '\"\"'"
        " ELSE CAST(distance_to_event AS VARCHAR) END AS JSON)",
        "event_url := event_url", "event_title := coalesce(event_title, '')",
        "event_type := event_type", "event_state := event_state",
        f"firstname := {FIRST_NAME}", f"lastname := {LAST_NAME}", *more,
    ]
    return f"CAST(to_json(struct_pack({', '.join(fields)})) AS VARCHAR)"


def _quoted(json: str) -> str:
    return f"replace(url_encode({json}), '%2F', '/')"


PAYLOAD = """email, secondary_id, cons_id, CAST(ds AS VARCHAR) AS ds, event_url, event_title,
    CAST(distance_to_event AS DOUBLE) AS distance_to_event"""

def _ascii_fold_scripts() -> str:
    initial, vowel, ending = (f"replace(string_split('{sounds}', ' ')[{{}} + 1], '-', '')" for sounds in HANGUL)
    n = "(c_custkey % 11172)"
    scripts = ", ".join(f"'{name}'" for name in SCRIPTS)
    return f"""
        SELECT c_custkey, unnest([{scripts}]) AS script, lower(c_mktsegment) AS folded FROM {{customer}}
        UNION ALL
        SELECT c_custkey, 'hangul', {initial.format(f'{n} // 588')} || {vowel.format(f'{n} % 588 // 28')}
               || {ending.format(f'{n} % 28')}
        FROM {{customer}}"""


BODIES = {
    "constituents": """
        SELECT email, cons_id, firstname, lastname, addr1, city, state_cd, state_name, zip,
               round(latitude, 4) AS latitude, round(longitude, 4) AS longitude FROM {people}""",
    "suppression_anti": """
        SELECT cons_id, cons_email_id FROM {cons_sub} s
        WHERE NOT EXISTS (SELECT 1 FROM {suppressed} x WHERE x.cons_id = s.cons_id)""",
    "zip_fallback": """
        SELECT cons_id, zip, round(lat, 4) AS latitude, round(lon, 4) AS longitude FROM {located}""",
    "rsvp_counts": "SELECT * FROM {rsvps}",
    "next_timeslots": """
        SELECT next_timeslot_id, event_id, CAST(start_date AS VARCHAR) AS start_date,
               strftime(start_timestamp, '%Y-%m-%d %H:%M:%S') AS start_timestamp,
               max_attendees, rsvp_count, spots_remaining FROM {next_slots}""",
    "timeslot_text": """
        SELECT y.event_id, formatted_start_times, csv_timeslot_urls, csv_start_times
        FROM {synopses} y JOIN {day_lists} u ON u.event_id = y.event_id
             JOIN {time_lists} t ON t.event_id = y.event_id""",
    "event_features": """
        SELECT event_id, event_url, event_title, event_summary, event_type, event_venue, event_addr1,
               event_city, event_state, event_zip, round(event_latitude, 4) AS event_latitude,
               round(event_longitude, 4) AS event_longitude, event_timezone,
               CAST(event_start_date AS VARCHAR) AS event_start_date,
               strftime(local, '%Y-%m-%d %H:%M:%S') AS event_start_timestamp_local,
               rpad(strftime(local, '%A'), 9, ' ') || ', ' || rpad(strftime(local, '%B'), 9, ' ')
                 || strftime(local, ' %d, %Y') AS event_start_formatted_date_local,
               lower(strftime(local, '%I:%M %p')) AS event_start_formatted_time_local,
               rpad(strftime(local, '%A'), 9, ' ') AS event_start_day_of_week_local,
               CAST(dayofweek AS INT) AS dayofweek, event_spots_remaining,
               formatted_start_times AS event_formatted_start_times,
               csv_timeslot_urls AS event_csv_timeslot_urls, csv_start_times AS event_csv_start_times
        FROM {features}""",
    "event_features_by_tag": """
        SELECT event_id, event_type, event_state FROM {features} f
        WHERE event_state IN ('R0', 'R1', 'R2') AND event_state NOT IN ('R1')
          AND EXISTS (SELECT 1 FROM {event_tags} t WHERE t.event_id = f.event_id AND t.tag_id IN (1, 2))""",
    "event_scores": "SELECT event_id, event_type, CAST(dayofweek AS INT) AS dayofweek, score_event FROM {scored}",
    "event_window": """
        SELECT CAST(d AS VARCHAR) AS ds, CAST(d + 3 AS VARCHAR) AS event_ds,
               CAST(d - 2 AS VARCHAR) AS quiet_start, CAST(d - 30 AS VARCHAR) AS approval_start,
               CAST(w AS INT) AS weekday, len AS window_length, CAST(d + 3 + len AS VARCHAR) AS window_end, n
        FROM (SELECT d, n, dayofweek(d + 3) AS w,
                     CASE dayofweek(d + 3) WHEN 0 THEN 3 WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 5
                          WHEN 4 THEN 4 WHEN 5 THEN 3 ELSE 3 END AS len
              FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM {orders} GROUP BY 1))""",
    "haversine": f"""
        SELECT id AS event_id, cons_id,
               round({MILES.format("latitude", "longitude", "location__lat", "location__lon")}, 4) AS miles
        FROM (SELECT e.id, c.cons_id, c.latitude, c.longitude, e.location__lat, e.location__lon
              FROM {{org_events}} e JOIN {{orders}} o ON o.o_orderkey = e.id
                   JOIN {{cons_addr}} c ON c.cons_id = o.o_custkey)""",
    "nearby_pairs": "SELECT cons_id, event_id, round(miles, 4) AS distance_to_event FROM {pairs}",
    "capacity_filter": """
        SELECT cons_id, event_id, cons_count, recipients_per_available_spots,
               round(miles, 4) AS distance_to_event FROM {roomy}""",
    "score_pairs": "SELECT cons_id, event_id, round(score, 4) AS score_event_cons FROM {roomy}",
    "best_event": """
        SELECT cons_id, email, event_id, round(miles, 4) AS distance_to_event, score_event,
               round(score, 4) AS score_event_cons, CAST(event_start_date AS VARCHAR) AS event_start_date
        FROM {best}""",
    "invite_staging": "SELECT cons_id, email, event_id FROM {staged}",
    "payload_upsert": f"""
        SELECT CAST(p.ds AS VARCHAR) AS ds, p.cons_id, p.email, p.event_url FROM {{payloads}} p
        WHERE p.ds <> {DAY} OR NOT EXISTS (SELECT 1 FROM {{staged}} s WHERE s.email = p.email)
        UNION ALL
        SELECT CAST({DAY} AS VARCHAR), b.cons_id, b.email, f.event_url
        FROM {{staged}} b JOIN {{features}} f ON f.event_id = b.event_id""",
    "scheduling_upsert": f"""
        SELECT CAST(ds AS VARCHAR) AS ds, cons_id, email, secondary_id, mailing_name FROM {{schedulings}}
        UNION ALL
        SELECT CAST({DAY} AS VARCHAR), cons_id, email, NULL, 'event_invite' FROM {{staged}}""",
    "reset_schedulings": """
        SELECT CAST(ds AS VARCHAR) AS ds, cons_id, email, secondary_id, mailing_name FROM {schedulings} s
        WHERE s.ds <> DATE '2020-02-01' OR s.mailing_name <> 'event_approval'
           OR EXISTS (SELECT 1 FROM {sends} d WHERE d.ds = s.ds AND d.mailing_name = s.mailing_name)""",
    "ledger_publish": f"""
        SELECT CAST({DAY} AS VARCHAR) AS ds, b.cons_id, b.email,
               CAST(CAST(round(b.miles, 2) AS DECIMAL(10, 2)) AS DOUBLE) AS distance_to_event,
               f.event_url, f.formatted_start_times AS event_formatted_start_times
        FROM {{staged}} b JOIN {{features}} f ON f.event_id = b.event_id""",
    "schedule_two_days": _staged_on(2),
    "schedule_eight_days": _staged_on(8),
    "next_timeslot_min": """
        SELECT event_id, strftime(start_timestamp, '%Y-%m-%d %H:%M:%S') AS start_timestamp,
               CAST(CAST(timezone('America/New_York', timezone('UTC', start_timestamp)) AS DATE) AS VARCHAR)
                 AS start_date FROM {first_starts}""",
    "approved_events": """
        SELECT * REPLACE (CAST(ds AS VARCHAR) AS ds, CAST(event_start_date AS VARCHAR) AS event_start_date,
                          strftime(event_reviewed_at, '%Y-%m-%d %H:%M:%S') AS event_reviewed_at)
        FROM {approved}""",
    "approval_staging": "SELECT email, secondary_id, event_url FROM {approval_staged}",
    "approval_stream": "SELECT email, secondary_id, event_url FROM {approval_staged}",
    "approval_stream_late_timeslots": "SELECT email, secondary_id, event_url FROM {approval_staged}",
    "pending_sends": f"SELECT {PAYLOAD}, strftime(scheduled_at, '%Y-%m-%d %H:%M:%S') AS scheduled_at FROM {{pending}}",
    "pending_count": "SELECT CAST(ds AS VARCHAR) AS ds, count(*) AS c FROM {pending} GROUP BY ds",
    "send_batches": """
        SELECT email, position, position // 50 AS batch, position % 50 AS batch_index FROM {numbered}""",
    "whitelist": """
        SELECT email, position FROM (
          SELECT email, row_number() OVER (ORDER BY ds, email, secondary_id NULLS LAST, scheduled_at,
                                           cons_id) - 1 AS position
          FROM {pending} WHERE email IN (SELECT email FROM {messages}))""",
    "override_round_robin": """
        SELECT email, position, CASE (position % 50) % 2
               WHEN 0 THEN 'stress+' || CAST(position % 50 AS VARCHAR) || '@example.net'
               ELSE 'second@example.net' END AS destination FROM {numbered}""",
    "outbound_requests": f"""
        SELECT position, position // 50 AS batch, position % 50 AS batch_index,
               email AS original_email, 'to' AS kind, email, 'M2' AS mailing_id, 0 AS email_opt_in,
               {_quoted(_request_json("email"))} AS trigger_values FROM {{numbered}}
        UNION ALL
        SELECT position, position // 50, position % 50, email, 'cc', 'copy@example.net', 'M2', 0,
               {_quoted(_request_json("email", "subject_prefix := '[orig ' || email || ']'"))}
        FROM {{numbered}}""",
    "template_requests": f"""
        SELECT position, position // 50 AS batch, position % 50 AS batch_index,
               email AS original_email, 'from@example.org' AS source, destination AS to_addresses,
               'bcc@example.org' AS bcc_addresses, 'reply@example.org' AS reply_to_addresses,
               mailing_name AS template,
               {_request_json("destination",
                   "subject_prefix := '[ override ' || destination || ' orig ' || email || ' ]'")}
                 AS template_data, 'invites' AS configuration_set_name
        FROM (SELECT *, 'stress+' || CAST(position % 50 AS VARCHAR) || '@example.net' AS destination
              FROM {{numbered}})""",
    "placeholder_sends": """
        SELECT CAST(ds AS VARCHAR) AS ds, cons_id, email, secondary_id, mailing_name,
               '2020-02-12' AS sent_ds, '2020-02-12 09:00:00' AS sent_at, 'M2' AS mailing_id,
               'PLACE' AS mailing_recipient_id, 'PLACE' AS mailing_send_id,
               CAST(NULL AS VARCHAR) AS deferred_task_id FROM {pending}""",
    "classify_send": """
        SELECT secondary_id, email, CASE WHEN status = 202 AND body <> '' THEN 'DEFER' ELSE recipient END
                 AS mailing_recipient_id, coalesce(send, recipient) AS mailing_send_id,
               task AS deferred_task_id FROM {send_outcomes}""",
    "classify_deferred": """
        SELECT secondary_id, email, recipient AS mailing_recipient_id,
               coalesce(send, recipient) AS mailing_send_id, task AS deferred_task_id
        FROM {deferred_outcomes}""",
    "classify_ses": """
        SELECT secondary_id, email,
               CASE WHEN value > 10 THEN 'm' || task ELSE 'ERROR' END AS mailing_recipient_id,
               CASE WHEN value > 10 THEN 'invites' ELSE 'ERROR' END AS mailing_send_id
        FROM {messages}""",
    "apply_outcomes": """
        SELECT CAST(ds AS VARCHAR) AS ds, cons_id, email, secondary_id, mailing_name,
               recipient AS mailing_recipient_id, send AS mailing_send_id, task AS deferred_task_id
        FROM {states} WHERE recipient <> 'ERROR'""",
    "reset_sends": """
        SELECT CAST(ds AS VARCHAR) AS ds, cons_id, email, mailing_recipient_id FROM {sends}
        WHERE NOT (ds IN (DATE '2020-02-10', DATE '2020-02-11') AND mailing_recipient_id = 'PLACE')""",
    "pending_deferrals": """
        SELECT CAST(ds AS VARCHAR) AS ds, cons_id, email, deferred_task_id,
               row_number() OVER (ORDER BY ds, email, secondary_id NULLS LAST, sent_at, cons_id) - 1
                 AS position
        FROM {sends} WHERE mailing_recipient_id = 'DEFER' AND mailing_send_id = 'DEFER'""",
    "forecast_detail": """
        SELECT email, CAST(ds AS VARCHAR) AS ds, event_state, event_url, event_title FROM {joined}""",
    "forecast_all_time": """
        SELECT CAST(ds AS VARCHAR) AS ds, event_state, event_url, event_type, count(*) AS cons_count
        FROM {joined} GROUP BY ALL""",
    "forecast_by_week": """
        SELECT CAST(CAST(date_trunc('week', ds) AS DATE) AS VARCHAR) AS week_begin, count(*) AS cons_count
        FROM {joined} GROUP BY 1""",
    "forecast_report": """
        SELECT CAST(ds AS VARCHAR) AS ds, event_state, count(*) AS cons_count FROM {joined} GROUP BY ALL""",
    "audience_group": "SELECT cons_id FROM {pending}",
    "audience_map": "SELECT cons_id, cons_id AS cons_id_event_invite FROM {pending}",
    "audience_dataset": """
        SELECT cons_id AS cons_id_event_invite, firstname, event_title, event_state FROM (
          SELECT *, row_number() OVER (PARTITION BY cons_id ORDER BY ds, email, secondary_id NULLS LAST,
                                       scheduled_at) AS n FROM {pending}) WHERE n = 1""",
    "personalization_long": """
        SELECT cons_id AS cons_id_event_invite, u.slug, u.value FROM {pending},
          LATERAL (VALUES ('inv_firstname', firstname), ('inv_event_title', event_title),
                          ('inv_event_state', event_state)) u(slug, value)""",
    "recipient_group_file": "SELECT CAST(cons_id AS VARCHAR) AS cons_id FROM {pending}",
    "payload_massage": """
        SELECT email, coalesce(event_title, '') AS event_title, event_type,
               CASE WHEN distance_to_event = 0 THEN '' ELSE CAST(distance_to_event AS VARCHAR) END
                 AS distance_to_event,
               CASE WHEN cons_id = 0 THEN '' ELSE CAST(cons_id AS VARCHAR) END AS cons_id FROM {payloads}""",
    "ascii_fold_scripts": _ascii_fold_scripts(),
    "ascii_fold": r"""
        SELECT doc_id, regexp_replace(strip_accents(replace(text, 'ß', 'ss')), '[^\x00-\x7F]', '', 'g')
                 AS folded FROM {documents}""",
    "name_case": f"""
        SELECT cons_id, {FIRST_NAME} AS firstname, {LAST_NAME} AS lastname FROM {{cons}}""",
    "group_responses": """
        SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN NULL ELSE s_suppkey END AS group_id,
               CASE WHEN s_acctbal < 0 THEN 'No group ' || s_name END AS error
        FROM {supplier}""",
    "event_reach": """
        SELECT event_url, CAST(ds AS VARCHAR) AS ds,
               count(*) FILTER (WHERE sent) AS invited, count(*) FILTER (WHERE NOT sent) AS to_invite
        FROM (SELECT j.event_url, j.ds, EXISTS (SELECT 1 FROM {sends} d WHERE d.ds = j.ds
                     AND d.email = j.email AND d.secondary_id IS NOT DISTINCT FROM j.secondary_id
                     AND d.mailing_name = j.mailing_name) AS sent FROM {joined} j)
        GROUP BY event_url, ds""",
    "send_status_summary": """
        SELECT CAST(ds AS VARCHAR) AS ds, status, count(*) AS n FROM (
          SELECT ds, CASE WHEN mailing_recipient_id IN ('PLACE', 'DEFER', 'UNSUB', 'INVAL', 'UNKNO')
                          THEN mailing_recipient_id ELSE 'SENT' END AS status FROM {sends}
          UNION ALL
          SELECT s.ds, 'PENDING' FROM {schedulings} s WHERE s.mailing_name = 'event_invite'
             AND NOT EXISTS (SELECT 1 FROM {sends} d WHERE d.ds = s.ds AND d.email = s.email
                             AND d.secondary_id IS NOT DISTINCT FROM s.secondary_id
                             AND d.mailing_name = s.mailing_name))
        GROUP BY ds, status""",
    "ad_hoc_sql": """
        SELECT a.state_cd, count(*) AS people FROM {cons_addr} a JOIN {cons_sub} s ON s.cons_id = a.cons_id
        WHERE s.isunsub = 0 GROUP BY a.state_cd""",
}

BODIES["nearby_pairs_grid"] = BODIES["nearby_pairs"]
BODIES["personalization_files"] = BODIES["personalization_long"]
BODIES["identity_map_file"] = BODIES["audience_map"]
BODIES["ledger_sending"] = BODIES["apply_outcomes"]
BODIES["send_batches_limited"] = BODIES["send_batches"] + " WHERE position < 100"
BODIES["pending_total"] = "SELECT count(*) AS c FROM {pending}"
BODIES["deferrals_total"] = """
    SELECT count(*) AS c FROM {sends} WHERE mailing_recipient_id = 'DEFER' AND mailing_send_id = 'DEFER'"""


def oracle_sql() -> dict[str, str]:
    return {name: assemble(STEPS, body) for name, body in BODIES.items()}
