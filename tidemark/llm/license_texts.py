"""Licence templates: fixed values from the public licence texts."""

from __future__ import annotations

#: Base phrases, found where all their words stand consecutively.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: (label, text) of notices and licence texts.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all "
            "copies or substantial portions of the Software."),
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may not use this file except in compliance with the License. You may obtain a copy of the License "
               "at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
               "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
               "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation, either version 3 of the License, "
            "or (at your option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met: Redistributions of source code must retain the above copyright "
            "notice, this list of conditions and the following disclaimer."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
            "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
)
