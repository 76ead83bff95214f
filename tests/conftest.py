import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

CASUALTY_CSV = """collision_index,vehicle_reference,casualty_class,sex_of_casualty,age_of_casualty,casualty_severity,casualty_type
C1,1,1,1,34,3,9
C1,1,2,2,-1,3,9
C1,2,2,2,-1,3,9
C2,1,3,9,21,1,0
C3,1,1,1,-1,2,1
C4,1,1,2,50,3,-1
C9,1,1,1,40,3,9
"""

COLLISION_CSV = """collision_index,police_force,collision_severity,date,day_of_week,time,road_type,speed_limit,light_conditions,weather_conditions,road_surface_conditions,urban_or_rural_area
C1,7,3,05/03/2019,3,08:15,6,30,1,1,1,1
C2,7,1,24/12/2020,5,23:40,3,60,4,-1,2,-1
C3,7,2,01/01/2021,6,13:05,6,-1,1,1,-1,2
C4,7,3,02/02/2022,4,16:59,-1,30,1,1,1,1
"""


@pytest.fixture(scope="session")
def spark():
    from sevlab.session import local_session

    s = local_session(4, shuffle_partitions=4, app="sevlab-tests",
                      checkpoint_dir=tempfile.mkdtemp(prefix="sevlab-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def csv_dir():
    d = tempfile.mkdtemp(prefix="sevlab-test-csv-")
    os.makedirs(f"{d}/casualty")
    os.makedirs(f"{d}/collision")
    with open(f"{d}/casualty/part-0.csv", "w") as f:
        f.write(CASUALTY_CSV)
    with open(f"{d}/collision/part-0.csv", "w") as f:
        f.write(COLLISION_CSV)
    return d


@pytest.fixture(scope="session")
def joined(spark, csv_dir):
    from sevlab.plans import road
    return road.integrate_csv(spark, [(f"{csv_dir}/casualty", f"{csv_dir}/collision")])
